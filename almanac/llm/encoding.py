"""Token ids of whole texts by a public vocabulary file, with a bounded cache of words per worker.

Vocabularies whose pre-tokenizer drops white space give a text the ids of its white-space
separated words, one after another, so each different word is encoded once. Other
vocabularies, and texts that hold a special string, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words a worker keeps; when full, all are forgotten.
CACHE_WORDS = 250_000
#: Longer words are encoded each time, so that the cache's bytes are bounded too.
CACHE_WORD_BYTES = 64
#: Words handed to the tokenizer in one call.
CALL_WORDS = 2_000
LINE_WORDS = 50


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (lengths[0] numbers), starts[1], ..."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


#: Letters that lower-case one by one and are composed already, then marks other than the apostrophe.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable Latin-1 bytes as they are and the others as the letters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


class _Pieces:
    """Ids of letter runs and of mark runs; piece 0 is empty."""

    def __init__(self):
        self.at: dict[str, int] = {}
        self.n, self._ids = 1, 0
        self._added = [(np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint32))]

    def add(self, lengths: np.ndarray, ids: np.ndarray) -> None:
        self._added.append((self._ids + np.cumsum(lengths) - lengths, lengths, ids))
        self.n += len(lengths)
        self._ids += len(ids)

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, lengths and ids of all pieces."""
        self._added = [tuple(map(np.concatenate, zip(*self._added, strict=True)))]
        return self._added[0]


@dataclass(frozen=True)
class Lengths:
    """A table of words and how many tokens each has."""

    words: pa.Array
    tokens: np.ndarray


class Encoder:
    """ids of texts."""

    def __init__(self, path: str, most_words: int = CACHE_WORDS):
        self.path, self.most_words = path, most_words
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda text: model.encode(text)
            self.by_word, self.special = False, []
        else:
            from tokenizers import Tokenizer

            with open(path, encoding="utf-8") as file:
                spec = json.load(file)
            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            self.whole = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
            self.by_word = _drops_white_space(spec)
            self.special = [t["content"] for t in spec.get("added_tokens", [])]
            self._plain_words(spec)
        self.pieces = _Pieces()
        self._clear()

    def _plain_words(self, spec: dict) -> None:
        """Where the steps before the merges only lower-case and split off marks, letters go straight to the merges."""
        from tokenizers import Tokenizer

        known = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
        suffix = spec["model"].get("end_of_word_suffix")
        self.letters = None
        if self.by_word and suffix and (spec.get("normalizer") or {}).get("normalizers") == known \
                and [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]] == ["Split", "ByteLevel"]:
            bare = spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
            self.letters = Tokenizer.from_str(json.dumps(bare))
            self.ends_word = np.zeros(max(spec["model"]["vocab"].values()) + 1, bool)
            self.ends_word[[i for word, i in spec["model"]["vocab"].items() if word.endswith(suffix)]] = True

    def _clear(self) -> None:
        self.words = pa.array([], pa.string())
        self.starts = self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths per word and all ids. A plain word is letters and then perhaps marks, each encoded once."""
        if self.pieces.n > self.most_words:
            self.pieces = _Pieces()
        pieces, first, second = self.pieces, [], []
        cores: list[str] = []
        marks: list[str] = []
        odd: list[str] = []
        rest: list[int] = []
        for i, word in enumerate(words):
            plain = _PLAIN(word) if self.letters else None
            if plain is None:
                rest.append(i)
                odd.append(word)
                first.append(0)
                second.append(0)
                continue
            core, mark = plain[1].lower(), plain[2]
            at = pieces.at.get(core)
            if at is None:
                at = pieces.at[core] = pieces.n + len(cores)
                cores.append(core)
            first.append(at)
            second.append(mark)
        if cores:
            pieces.add(*self._letter_words(cores))
        for i, mark in enumerate(second):
            if mark:
                if (at := pieces.at.get(mark)) is None:
                    ids = self.whole(mark)
                    at = pieces.at[mark] = pieces.n
                    pieces.add(np.array([len(ids)]), np.array(ids, np.uint32))
                second[i] = at
            else:
                second[i] = 0
        parts = np.array([first, second], np.int64).T
        if odd:
            parts[rest, 0] = pieces.n + np.arange(len(odd))
            for start in range(0, len(odd), CALL_WORDS):
                part = odd[start : start + CALL_WORDS]
                got = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
                pieces.add(np.bincount(np.array(got.word_ids, np.int64), minlength=len(part)), np.array(got.ids, np.uint32))
        starts, lengths, ids = pieces.all()
        lengths = lengths[parts]
        return lengths.sum(axis=1), ids[ragged(starts[parts.ravel()], lengths.ravel())]

    def _letter_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's merges on lower-case letters that are already in the vocabulary's byte alphabet."""
        mapped = [word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS) for word in words]
        lines = [" ".join(mapped[at : at + LINE_WORDS]) for at in range(0, len(mapped), LINE_WORDS)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.letters.encode_batch_fast(lines, add_special_tokens=False)])
        ends = np.flatnonzero(self.ends_word[ids])
        return np.diff(np.append(-1, ends)), ids

    def _learn(self, words: list[str]) -> None:
        lengths, ids = self._encode_words(words)
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        self.words = pa.concat_arrays([self.words, pa.array(words, pa.string())])
        self.starts, self.lengths = np.concatenate([self.starts, starts]), np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])

    def table(self, words: list[str]) -> Lengths:
        """Lengths of words without white space, each a different one; empty where this vocabulary's tokens span gaps."""
        if not self.by_word or not words:
            return Lengths(pa.array([], pa.string()), np.zeros(0, np.int32))
        return Lengths(pa.array(words, pa.string()), self._encode_words(words)[0].astype(np.int32))

    def _coded(self, texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
        """Words per text, and all words, numbered."""
        split = pc.ascii_split_whitespace(texts)
        flat = split.flatten()
        keep = pc.not_equal(flat, "")
        per_text = np.add.reduceat(np.append(np.asarray(keep, np.int64), 0), split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()) \
            if len(texts) else np.zeros(0, np.int64)
        per_text = np.where(np.diff(split.offsets.to_numpy()) > 0, per_text, 0)
        return per_text, flat.filter(keep).dictionary_encode()

    def _looked_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each of the different words where its ids start and how many there are, and the ids."""
        if len(self.words) > self.most_words:
            self._clear()
        known = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(known))
        short = pc.less_equal(pc.binary_length(new), CACHE_WORD_BYTES)
        self._learn(new.filter(short).to_pylist())
        once = new.filter(pc.invert(short)).to_pylist()
        if new:
            known = pc.index_in(words, value_set=self.words)
        at = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        starts, lengths, ids = self.starts, self.lengths, self.ids
        if once:
            own, more = self._encode_words(once)
            at[at < 0] = len(starts) + np.arange(len(once))
            starts = np.concatenate([starts, len(ids) + np.cumsum(own) - own])
            lengths, ids = np.concatenate([lengths, own]), np.concatenate([ids, more])
        return starts[at], lengths[at], ids

    def _by_word(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words per text; then for each word where its ids start and how many there are, and the ids."""
        per_text, coded = self._coded(texts)
        starts, lengths, ids = self._looked_up(coded.dictionary)
        codes = coded.indices.to_numpy()
        return per_text, starts[codes], lengths[codes], ids

    def _word_lengths(self, words: pa.Array, table: Lengths | None) -> np.ndarray:
        """Tokens of each of the different words: from the table, and those it misses from the cache."""
        if table is None or not len(table.words):
            return self._looked_up(words)[1]
        found = pc.index_in(words, value_set=table.words)
        missed = pc.is_null(found).to_numpy(zero_copy_only=False)
        lengths = table.tokens[pc.fill_null(found, 0).to_numpy(zero_copy_only=False)].astype(np.int64)
        if missed.any():
            lengths[missed] = self._looked_up(words.filter(pa.array(missed)))[1]
        return lengths

    def _whole_rows(self, texts: pa.Array) -> np.ndarray:
        if not self.by_word:
            return np.ones(len(texts), bool)
        found = np.zeros(len(texts), bool)
        for special in self.special:
            found |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        return found

    def count(self, texts: pa.Array, table: Lengths | None = None) -> np.ndarray:
        """Tokens per text; no nulls in `texts`. Only words that the table misses are encoded or kept."""
        whole = self._whole_rows(texts)
        counts = np.zeros(len(texts), np.int64)
        if not whole.all():
            per_text, coded = self._coded(texts.filter(pa.array(~whole)))
            lengths = self._word_lengths(coded.dictionary, table)[coded.indices.to_numpy()]
            ends = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(per_text))]
            counts[~whole] = np.diff(ends)
        for row in np.flatnonzero(whole):
            counts[row] = len(self.whole(texts[row].as_py()))
        return counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ends, ids): text i has ids[ends[i] : ends[i + 1]]; no nulls in `texts`."""
        whole = self._whole_rows(texts)
        if not whole.any():
            per_text, starts, lengths, ids = self._by_word(texts)
            ends = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(per_text))]
            return ends, ids[ragged(starts, lengths)]
        parts = []
        for row, alone in enumerate(whole):
            parts.append(np.array(self.whole(texts[row].as_py()), np.uint32) if alone else self.encode(texts.slice(row, 1))[1])
        return np.append(0, np.cumsum([len(p) for p in parts])), np.concatenate(parts)


def _drops_white_space(spec: dict) -> bool:
    """Whether the first pre-tokenizer keeps only matches without white space, so that no token spans or sees a gap."""
    first = spec.get("pre_tokenizer") or {}
    if first.get("type") == "Sequence":
        first = first["pretokenizers"][0]
    pattern = first.get("pattern", {}).get("Regex", "")
    return first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True \
        and r"[^\s" in pattern and not spec.get("post_processor") and r"\s+" not in pattern


@lru_cache(maxsize=2)
def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker, kept over its tasks."""
    return Encoder(path)
