"""A worker holds one encoder: another one takes the place of the former and of its words."""

from slotbook.llm import word_memory as M


class Encoder:
    def __init__(self, path):
        self.words = M.WordMemory(lambda new: {w: w for w in new})


def test_another_encoder_takes_the_place(monkeypatch):
    given = []
    monkeypatch.setattr(M, "_encoders", {})
    monkeypatch.setattr(M, "_active", [])
    monkeypatch.setattr(M, "give_back", lambda: given.append(1))
    first = M.kept_encoder("a", Encoder)
    first.words.values([[b"x", b"y"]])
    assert M.kept_encoder("a", Encoder) is first and first.words.young and not given
    second = M.kept_encoder("b", Encoder)
    assert list(M._encoders.values()) == [second] and not first.words.young and given == [1]
    # the former one still works where it is held, and takes the words' place
    second.words.values([[b"z"]])
    assert first.words.values([[b"x"]]) == [[b"x"]] and not second.words.young
