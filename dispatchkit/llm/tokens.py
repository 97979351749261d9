"""Token ids of whole texts, inside Spark tasks.

The tokenizers library encodes; this module spares it repeated work. Texts are cut where a cut
cannot change the result (at blanks), Arrow finds the distinct words of a slice of rows, a word
of letters and trailing signs falls apart into its two pre-tokens, and each distinct pre-token is
handed to the vocabulary's model once per Python worker. numpy then gathers the documents' ids.
Other words are pre-tokenized one by one or encoded by the library; texts whose blanks do not
allow cuts are encoded whole. The cache is bounded and only a matter of speed.
"""

from __future__ import annotations

import numpy as np
import regex

MAX_PARTS = 700_000

#: How the two supported kinds of vocabulary file pre-tokenize (fixed by the files).
WORD_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
BYTE_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
PLAIN = regex.compile(r"[!-~¡-ÿ]+")
#: Letters, then signs (no apostrophe, no digit): exactly two pre-tokens in either kind.
TWO_PARTS = r"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<signs>[!-&(-/:-@\[-`{-~]*)$"

_loaded: dict = {}


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte (fixed rule:
    printable Latin-1 stands for itself, the rest follows from code point 256 on)."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


LETTERS = byte_letters()


def load(path: str) -> "Encoder":
    """The worker's encoder for a vocabulary file (one per process)."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


class Runs:
    """Id runs put one after another; a run is known by its number."""

    def __init__(self, dtype):
        self.data, self.sizes, self.item = [], [], dtype.itemsize

    def add(self, ids: bytes) -> int:
        self.data.append(ids)
        self.sizes.append(len(ids) // self.item)
        return len(self.sizes) - 1

    def gather(self, which: np.ndarray, dtype) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the runs in that order, running total of their sizes)."""
        size, flat = np.array(self.sizes, np.int64), np.frombuffer(b"".join(self.data), dtype)
        first, n = np.cumsum(size) - size, size[which]
        upto = np.cumsum(n)
        total = int(upto[-1]) if len(upto) else 0
        return flat[np.repeat(first[which] - upto + n, n) + np.arange(total)], upto


class Encoder:
    def __init__(self, path: str):
        import os
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.by_word = any(token.endswith("</w>") for token in vocab)
        self.parts: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, self.dtype).tobytes()

    def part(self, text: str) -> bytes:
        """Ids of one pre-token."""
        known = self.parts.get(text)
        if known is None:
            letters = text.encode().decode("latin-1").translate(LETTERS)
            known = np.array([t.id for t in self.tokenizer.model.tokenize(letters)], self.dtype).tobytes()
            self.parts[text] = known
        return known

    def other(self, word: str, lead: str) -> bytes:
        """Ids of a word that is not of the two-part shape."""
        if not PLAIN.fullmatch(word) or "<|" in word:
            return self.whole(lead + word)
        parts = WORD_PARTS.findall(word.lower()) if self.by_word else BYTE_PARTS.findall(lead + word)
        return b"".join([self.part(p) for p in parts])

    def word_runs(self, words, lead: str, runs: Runs) -> np.ndarray:
        """Two run numbers for each of the distinct words (the second may be an empty run)."""
        import pyarrow as pa
        import pyarrow.compute as pc
        if len(self.parts) > MAX_PARTS:
            self.parts = {}
        out = np.full((len(words), 2), runs.add(b""), np.int64)
        split = pc.extract_regex(words, TWO_PARTS)
        plain = pc.is_valid(split).to_numpy(zero_copy_only=False)
        core, signs = split.field(0), split.field(1)
        for column, values, before in ((0, pc.utf8_lower(core) if self.by_word else core, lead), (1, signs, "")):
            values = pc.dictionary_encode(pc.if_else(pc.is_valid(split), values, pa.scalar(None, pa.string())))
            numbers = np.array([runs.add(self.part(before + v) if v else b"") for v in values.dictionary.to_pylist()], np.int64)
            at = values.indices.fill_null(0).to_numpy(zero_copy_only=False)
            if len(numbers):
                out[plain, column] = numbers[at[plain]]
        rest = np.flatnonzero(~plain)
        out[rest, 0] = [runs.add(self.other(w, lead)) for w in words.take(pa.array(rest)).to_pylist()]
        return out

    def encode(self, texts, end_id: int | None = None) -> list[np.ndarray]:
        """Ids of each text of an Arrow column or a list (None: no text), ``end_id`` appended."""
        import pyarrow as pa
        import pyarrow.compute as pc
        texts = pc.fill_null((texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.string()), "")
        cut = self._by_word if self.by_word else self._by_line
        ids, upto, odd = cut(texts, pc)
        tail = np.array([] if end_id is None else [end_id], dtype=self.dtype)
        out = [np.concatenate([ids[a:b], tail]) for a, b in zip(upto, upto[1:])]
        for i in odd:
            out[i] = np.concatenate([np.frombuffer(self.whole(texts[i].as_py()), self.dtype), tail])
        return out

    def _by_word(self, texts, pc):
        words = pc.ascii_split_whitespace(texts)
        first = words.offsets.to_numpy()
        coded = pc.dictionary_encode(words.values.slice(first[0], first[-1] - first[0]))
        runs = Runs(self.dtype)
        numbers = self.word_runs(coded.dictionary, "", runs)
        ids, upto = runs.gather(numbers[coded.indices.to_numpy()].ravel(), self.dtype)
        return ids, np.concatenate([[0], upto])[2 * (first - first[0])], []

    def _by_line(self, texts, pc):
        lines = pc.split_pattern(texts, "\n")
        line_at = lines.offsets.to_numpy() - lines.offsets[0].as_py()
        words = pc.split_pattern(lines.flatten(), " ")
        word_at = words.offsets.to_numpy() - words.offsets[0].as_py()
        coded = pc.dictionary_encode(words.flatten())
        which = coded.indices.to_numpy().astype(np.int64)
        # a cut is safe unless a word is empty (two blanks in a row) or has a blank at an edge
        distinct = coded.dictionary.to_pylist()
        blank = np.array([not w or w[0].isspace() or w[-1].isspace() for w in distinct], bool)
        starts = np.concatenate([[0], np.cumsum(blank[which])])
        doc_at = word_at[line_at]
        odd = np.flatnonzero(starts[doc_at[1:]] > starts[doc_at[:-1]])
        runs = Runs(self.dtype)
        spaced = self.word_runs(coded.dictionary, " ", runs)
        heads = word_at[:-1]                                    # first word of each line: no space before it
        head = pc.dictionary_encode(coded.take(_array(heads)).cast("string"))
        bare = self.word_runs(head.dictionary, "", runs)
        three = np.full((len(which), 3), runs.add(b""), np.int64)
        three[:, 1:] = spaced[which]
        three[heads, 1:] = bare[head.indices.to_numpy()]
        later = np.ones(len(heads), bool)
        later[line_at[:-1]] = False                             # a line but a text's first follows a line break
        three[heads[later], 0] = runs.add(self.whole("\n"))
        ids, upto = runs.gather(three.ravel(), self.dtype)
        return ids, np.concatenate([[0], upto])[3 * doc_at], odd.tolist()


def _array(x):
    import pyarrow as pa
    return pa.array(x)


def slices(texts, limit: int = 8_000_000):
    """(from, to) row ranges of an Arrow string column with about ``limit`` bytes each."""
    import pyarrow.compute as pc
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(sizes):
        base = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield lo, hi
        lo = hi
