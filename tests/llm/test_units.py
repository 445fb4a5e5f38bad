"""The operators' plain functions against simpler versions of themselves."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from slotbook.llm import chat, decontaminate, hashing, html_text, ngram_join, packing, token_count, word_ids
from slotbook.llm.quality import repeated_words
from slotbook.llm.queries import WORD_BPE
from slotbook.llm.word_ids import WordIds

TEXT = st.text(st.sampled_from("aB é|<\\\n \t.,!'s9#*_\u0308İ\u00a0\x1cΣ-"), max_size=40)


@pytest.fixture(scope="module")
def words():
    return WordIds(public_tokenizers.path(WORD_BPE))


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_kept_words_give_the_library_s_ids(texts):
    w = WORDS
    texts = [*texts, "".join(texts) + "<|endoftext|>x <|STARTOFTEXT|>"]
    want = [np.array(e.ids, "<u4").tobytes() for e in w.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert w.encode(texts) == want


WORDS = WordIds(public_tokenizers.path(WORD_BPE))


def test_spliced_pieces_give_the_whole_text_s_ids(words):
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdé'9.") for _ in range(rng.randrange(1, 12))) for _ in range(400))
    whole = words.tokenizer.encode(text, add_special_tokens=False)
    step, overlap = 300, 60
    total = 0
    pieces = token_count.pieces_of(text, step, overlap)
    edges = []
    for k, start, piece in pieces:
        e = words.tokenizer.encode(piece, add_special_tokens=False)
        ids, starts = np.array(e.ids, "<u4"), np.array([o[0] for o in e.offsets])
        left = {(p + start, s): c for p, c, s in token_count.boundaries(piece, ids, starts, 0, overlap)}
        right = {(p + start, s): c for p, c, s in token_count.boundaries(piece, ids, starts, step, len(piece))}
        edges.append((left, right, len(ids)))
    for (_, right, _), (left, _, _) in zip(edges, edges[1:], strict=False):
        at = min(set(left) & set(right))
        total += right[at] - left[at]
    assert total + edges[-1][2] == len(whole.ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 900), min_size=1, max_size=6), st.sampled_from([64, 256, 4096]), st.sampled_from([1, 16, 64]),
       st.booleans())
def test_rounds_place_every_token_once(sizes, window, packet, weighted):
    if not sum(sizes):
        return
    p = packing.Packing(window=window, packet=packet)
    weights = [float(i + 1) for i in range(len(sizes))] if weighted else None
    r = packing.Rounds(sizes, weights, p)
    seen = set()
    for k, size in enumerate(sizes):
        a = 0
        while a < size:
            n = min(size - a, 37)
            at, length, place = r.cuts(k, a, n, window)
            assert at[0] == 0 and (at[1:] == at[:-1] + length[:-1]).all() and at[-1] + length[-1] == n
            assert (place // window == (place + length - 1) // window).all()
            for m, q in zip(length.tolist(), place.tolist(), strict=True):
                new = set(range(q, q + m))
                assert not new & seen
                seen |= new
            a += n
    assert seen == set(range(sum(sizes)))


def test_many_documents_are_cut_as_one_by_one():
    p = packing.Packing(window=64, packet=8)
    r = packing.Rounds([3000, 70, 900], None, p)
    n = np.array([1, 63, 64, 65, 700, 7, 8, 9, 1500, 583], np.int64)
    a = np.cumsum(n) - n
    which, *many = r.cuts_of(0, a, n, p.window)
    for i in range(len(n)):
        for x, y in zip(many, r.cuts(0, int(a[i]), int(n[i]), p.window), strict=True):
            assert x[which == i].tolist() == y.tolist()


@pytest.mark.parametrize("columns", [[None, "", "a  b", "Zoë's <|endoftext|> x", "rock-n-roll... 42 Ünï <|"], ["b c", "d E f"], []])
def test_texts_of_a_column(columns):
    want = [WORDS.tokenizer.encode(t or "", add_special_tokens=False).ids for t in columns]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["skipped one", *columns, "the last"], kind).slice(1, len(columns))
        for each in (column, column.fill_null("")):
            assert [np.frombuffer(x, "<u4").tolist() for x in WORDS.encode(each)] == want


def test_slices_of_a_column(monkeypatch):
    monkeypatch.setattr(word_ids, "SLICE", 64)
    texts = [f"Some {'word ' * (i % 7)}number{i}, it's Über-{i}!" for i in range(200)]
    column = pa.array(texts, pa.string())
    parts = word_ids.slices(column.slice(50))
    assert [a for a, _ in parts] == [0, *(b for _, b in parts[:-1])] and parts[-1][1] == 150 and len(parts) > 20
    got = [x for a, b in parts for x in WORDS.encode(column.slice(50).slice(a, b - a))]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [
        WORDS.tokenizer.encode(t, add_special_tokens=False).ids for t in texts[50:]]


def test_windows_hold_the_target_shares():
    sizes = [400_000, 100_000, 30_000, 5_000]
    p = packing.Packing()
    r = packing.Rounds(sizes, None, p)
    held = np.zeros((sum(sizes) // p.window + 1, len(sizes)), np.int64)
    for k, size in enumerate(sizes):
        _, length, place = r.cuts(k, 0, size, p.window)
        np.add.at(held[:, k], place // p.window, length)
    share = np.array(sizes) / sum(sizes) * p.window
    assert np.abs(held[:-1] - share).max() <= 2 * p.packet * len(sizes)
    # deficits carry over: no queue falls behind by more than its packet, a window's drift aside
    assert np.abs(np.cumsum(held[:-1], 0) - share * np.arange(1, len(held))[:, None]).max() <= 2 * p.packet * len(sizes)


def test_the_tail_is_powers_of_two():
    start, ends = packing.tail_sequences(4096 * 3 + 1000, 4096)
    parts = np.diff([start, *ends]).tolist()
    assert sum(parts) == 1000 and all(x & (x - 1) == 0 for x in parts)


@given(st.text(st.sampled_from("<|\\im_endstar>\n ab"), max_size=30), st.text(st.sampled_from("a<|\\\nn"), max_size=8))
def test_rendering_is_reversible(text, role):
    piece, a, b = chat.render(role, text)
    assert chat.parse(piece) == (role, text) and chat.unescape(piece[a:b]) == text
    assert piece.count("<|") == 2


def test_events_fold_into_final_messages():
    e = [(1, 0, 0, "start", "user", "he"), (1, 0, 1, "delta", None, "llo"), (1, 1, 2, "start", "assistant", "a"),
         (1, 1, 3, "delta", None, "b"), (1, 1, 5, "regenerate", None, "x"), (1, 1, 6, "delta", None, "y"),
         (1, 2, 7, "start", "user", "t"), (1, 2, 8, "edit", None, "u"), (1, 2, 9, "start", "user", "again")]
    assert list(chat._messages(iter(e))) == [(1, 0, "user", "hello"), (1, 1, "assistant", "xy"), (1, 2, "user", "u"),
                                             (1, 2, "user", "again")]


def test_word_hashes_are_per_word():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "ab", "b", "é", "abc", "x" * 50]) for _ in range(rng.randrange(9))) for _ in range(50)]
    got = hashing.word_hashes([t.encode() for t in texts], hashing.SPACES)
    of = {}
    for t, h in zip(texts, got, strict=True):
        assert len(t.split()) == len(h)
        for w, x in zip(t.split(), h.tolist(), strict=True):
            assert of.setdefault(w, x) == x
    assert len(set(of.values())) == len(of)


def test_shingle_sets_have_the_exact_size():
    import brute as B
    texts = ["", "A b", "a B c d e f", "a b c d e a b c d e a b c d e", "É x y z w É x y z w"]
    assert [len(s) for s in ngram_join.shingle_sets(texts)] == [len(B.shingles(t)) for t in texts]


@given(st.lists(st.sampled_from("abc"), max_size=14))
def test_repeated_words(w):
    import brute as B
    assert repeated_words([x.encode() for x in w]) == B.quality_base(" ".join(w))[4]


@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12))
def test_longest_common_subsequence(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    assert decontaminate.lcs(a, b) == rows[-1][-1]


def test_blocks_know_their_surroundings():
    page = ("<body><nav><a href=x>Home</a></nav><div class='post-body content'><p>One<br>two <a>three</a><p>Four</div>"
            "<script>var a='<p>no</p>'</script><footer>End</footer>")
    b = html_text.blocks_of(page)
    assert [x.text for x in b] == ["Home", "One two three", "Four", "End"]
    assert [x.links for x in b] == [1.0, 1 / 3, 0.0, 0.0]
    assert [(x.content, x.furniture) for x in b] == [(False, True), (True, False), (True, False), (False, True)]
