"""Token ids of whole texts with a memory of words, for tokenizers whose words
are independent of each other.

With a tokenizer that marks word ends and drops white space, the ids of a text
are the ids of its white-space separated words one after the other.  Each word
is encoded by the tokenizer library once and kept; a text is then a join of the
kept ids.  Texts that hold ``<|`` (the start of the special strings, which the
library finds before lower-casing) go to the library whole, as do all texts of
any other kind of tokenizer.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from slotbook.llm.word_memory import WordMemory, kept_encoder

SLICE = 1 << 20       # bytes of text looked up at a time
JOINED = 256          # new words encoded by one call
PUNCTUATION = b".,;:!?*#$%&|()[]{}\"/\\-_=+~@^`"

def slices(texts: pa.Array) -> list[tuple[int, int]]:
    """Runs (from, to) of texts of some ``SLICE`` bytes, or of one text."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    out, a = [], 0
    while a < len(upto):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + SLICE, "right")))
        out.append((a, b))
        a = b
    return out


def encoder(path: str) -> WordIds:
    """One encoder for each vocabulary file and Python worker."""
    return kept_encoder(path, WordIds)


def words_are_independent(spec: dict) -> bool:
    """Whether the file describes a tokenizer that ends words with a suffix,
    and keeps only matches without white space of its word pattern."""
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    normal = {n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])}
    return (spec["model"].get("end_of_word_suffix") == "</w>" and first.get("type") == "Split"
            and first.get("behavior") == "Removed" and bool(first.get("invert"))
            and normal <= {"NFC", "Replace", "Lowercase"} and "Lowercase" in normal)


class WordIds:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        # each task has its core: threads of the library's own would only take turns
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            self.memo = words_are_independent(json.load(f))
        self.tokenizer = Tokenizer.from_file(path)
        # lower-case ASCII letters pass normaliser and word pattern unchanged: the same model without those
        self.lean = Tokenizer(self.tokenizer.model)
        self.lean.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.words = WordMemory(self._learn)

    def _whole(self, texts: list[str], lean: bool = False) -> list[bytes]:
        tokenizer = self.lean if lean else self.tokenizer
        return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: set[bytes]) -> dict[bytes, bytes]:
        """The ids of unknown words.  Punctuation around a word that starts and ends
        with a letter or digit is a word of its own for the tokenizer."""
        kept: dict[bytes, bytes] = {b"": b""}
        parts: list[tuple[bytes, bytes, bytes, bytes]] = []
        single: set[bytes] = set()
        plain: set[bytes] = set()
        known = self.words.known
        for w in new:
            if w.isalpha():          # ASCII letters alone, most words
                plain.add(w)
                continue
            core = w.strip(PUNCTUATION)
            if core and core != w:
                at = w.index(core)
                ascii_ends = core.isascii()
                if ascii_ends:
                    apart = core[:1].isalnum() and core[-1:].isalnum()
                else:
                    # as the tokenizer will see it: normalising may end a letter with a mark
                    c = unicodedata.normalize("NFC", core.decode("utf-8", "replace")).lower()
                    apart = (c[0].isalpha() or c[0] in "0123456789") and (c[-1].isalpha() or c[-1] in "0123456789")
                if apart:
                    parts.append((w, w[:at], core, w[at + len(core):]))
                    continue
            single.add(w)
        for _, *some in parts:
            for x in some:
                if x and x not in kept:
                    ids = known(x)
                    if ids is not None:
                        kept[x] = ids
                    elif x.isalpha():
                        plain.add(x)
                    else:
                        single.add(x)
        letters: list[bytes] = []
        other: list[bytes] = []
        for w in single:
            (letters if w.decode("utf-8", "replace").isalpha() else other).append(w)
        if other:
            kept.update(zip(other, self._whole([w.decode("utf-8", "replace") for w in other]), strict=True))
        self._joined(list(plain), kept, lean=True)
        self._joined(letters, kept, lean=False)
        for w, a, b, c in parts:
            kept[w] = kept[a] + kept[b] + kept[c]
        return kept

    def _joined(self, words: list[bytes], kept: dict[bytes, bytes], lean: bool) -> None:
        """Add the ids of words of letters alone, many encoded as one text."""
        groups = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        for some, raw in zip(groups, self._whole([b" ".join(g).decode("utf-8") for g in groups], lean), strict=True):
            cuts = (np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 1) * 4
            if len(cuts) == len(some):
                edges = cuts.tolist()
                kept.update(zip(some, [raw[a:b] for a, b in zip([0, *edges], edges, strict=False)], strict=True))
            else:   # a word that the tokenizer takes apart
                kept.update(zip(some, self._whole([w.decode("utf-8") for w in some]), strict=True))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text (null: as empty), no special tokens added."""
        if not isinstance(texts, pa.Array):
            texts = pa.array([t.encode("utf-8", "replace") for t in texts], pa.large_binary()).cast(pa.large_string())
        texts = texts.fill_null("")
        some = self._some if self.memo else lambda x: self._whole(x.to_pylist())
        return [ids for a, b in slices(texts) for ids in some(texts.slice(a, b - a))]

    def _some(self, texts: pa.Array) -> list[bytes]:
        special = np.flatnonzero(pc.match_substring(texts, "<|")).tolist()
        # lower-casing A-Z early changes no id outside special strings
        words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        # a word is looked up once for all its places in these texts
        coded = words.flatten().dictionary_encode()
        raw = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
        ids = self.words.once(coded.dictionary.cast(raw).to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        joined = np.frombuffer(b"".join(ids), "<u4")
        code = coded.indices.to_numpy()
        many = size[code]
        upto = np.concatenate([[0], np.cumsum(many)])
        out = joined[np.arange(upto[-1]) + np.repeat((np.cumsum(size) - size)[code] - upto[:-1], many)].tobytes()
        edges = (4 * upto[np.cumsum(pc.list_value_length(words).to_numpy())]).tolist()
        each = [out[a:b] for a, b in zip([0, *edges], edges, strict=False)]
        for i in special:
            each[i] = self._whole([texts[i].as_py()])[0]
        return each
