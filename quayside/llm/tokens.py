"""Token counts by overlap resynchronisation.

A text is encoded in chunks of ``chunk`` characters; neighbours overlap. Each
encoding gives the offsets where its pre-tokens begin and the number of tokens
before each. Two neighbours are spliced at a common boundary p of the overlap;
without one, the overlap is widened (doubled, at last the chunks are merged).

Why such a p is stable: the byte-level pre-tokenizer reads left to right and a
pre-token depends only on the text from its start to a few characters past its
end; merges never cross pre-tokens. So (1) what the left chunk says up to its
end minus ``margin`` (the longest special token, plus the look-ahead) is what
it says of the whole text, and (2) once the right chunk has a boundary at a
true boundary p, all its later boundaries are true as well.

Encoding a chunk: before a run of spaces and newlines that follows a character
that is no white space there is always a pre-token boundary, and no special
token holds a space. So a chunk whose only white space is spaces and newlines
is cut there into pieces ("run + word"), and the library's counts of pieces are
kept in a bounded per-worker cache (long ones only for their batch); other chunks go to the library whole, with
offsets. Tests hold both against the library on whole texts.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); ids and
repeated rows pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re

import numpy as np
from pyspark.sql import DataFrame

from .common import field, map_texts, worker_state

#: Characters of a chunk, first overlap of two chunks, cached pieces per worker.
CHUNK, OVERLAP, CACHE = 1 << 16, 256, 400_000
#: Longest piece that stays in the cache; longer ones may take so many characters.
LASTING, LONG_CHARS = 64, 4_000_000
_PIECES = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: White space (of any definition) other than space and newline.
_ODD = re.compile(r"[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")


class Counter:
    """Token counts of whole texts as the library for ``path`` gives them."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.path, self.chunk, self.overlap, self.most = path, chunk, overlap, cache
        self.lib = worker_state("tokenizer:" + path, lambda: Tokenizer.from_file(path))
        self.known: dict[str, int] = worker_state("pieces:" + path, dict)
        self.long: list[str] = worker_state("long pieces:" + path, list)
        added = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.margin = max([1, *map(len, added)]) + 3
        self.spaced = any(re.search(r"\s", t) for t in added)  # then no piece is sure

    def pieces(self, text: str) -> list[str] | None:
        """The text cut at sure boundaries, None if it has odd white space."""
        return None if self.spaced or _ODD.search(text) else _PIECES.findall(text)

    def forget(self) -> None:
        """Keep the cache within its bounds: entries, and characters of long pieces."""
        if len(self.known) > self.most:
            self.known.clear()
            self.long.clear()
        elif self.long and sum(map(len, self.long)) > LONG_CHARS:
            for p in self.long:
                self.known.pop(p, None)
            self.long.clear()

    def learn(self, pieces) -> None:
        self.forget()
        new = [p for p in set(pieces) if p not in self.known]
        for lo in range(0, len(new), 4096):
            part = new[lo:lo + 4096]
            for p, e in zip(part, self.lib.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[p] = len(e)
        self.long += [p for p in new if len(p) > LASTING]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of the chunk's pre-token boundaries (0 and the end included;
        of pieces: their starts) and the tokens before each."""
        pieces = self.pieces(text)
        if pieces is not None:
            self.learn(pieces)
            known = self.known
            size = np.fromiter(map(len, pieces), np.int64, len(pieces))
            toks = np.fromiter((known[p] for p in pieces), np.int64, len(pieces))
            return np.r_[0, np.cumsum(size)], np.r_[0, np.cumsum(toks)]
        e = self.lib.encode(text, add_special_tokens=False)
        word = np.array([-1 if w is None else w for w in e.word_ids], np.int64)
        start = np.array([a for a, _ in e.offsets], np.int64)
        head = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.array([], np.int64)
        return np.r_[start[head], len(text)], np.r_[head, len(word)]

    def count(self, text: str) -> int:
        if len(text) <= self.chunk:
            pieces = self.pieces(text)
            if pieces is None:
                return len(self.lib.encode(text, add_special_tokens=False))
            self.learn(pieces)
            return sum(map(self.known.__getitem__, pieces))
        return self.spliced(text)

    def spliced(self, text: str) -> int:
        """Count of a huge text, spliced from overlapping chunks."""
        total, a0, a1 = 0, 0, self.chunk  # the left chunk starts at a true boundary
        at, toks = self.encode(text[a0:a1])
        while a1 < len(text):
            overlap, p = self.overlap, None
            while p is None:
                b0 = max(a0, a1 - overlap)
                b1 = a1 + self.chunk
                bt, btoks = self.encode(text[b0:b1])
                if b0 == a0:  # widened to the whole left chunk: this one replaces it
                    break
                left, right = at + a0, bt[1:] + b0
                both = np.intersect1d(left[left <= a1 - self.margin], right[right < b1])
                p = int(both[0]) if len(both) else None
                overlap *= 2
            if p is not None:
                total += int(toks[np.searchsorted(at, p - a0)])
                k = int(np.searchsorted(bt, p - b0))
                bt, btoks = bt[k:] - bt[k], btoks[k:] - btoks[k]
                b0 = p
            a0, a1, at, toks = b0, min(b1, len(text)), bt, btoks
        return total + int(toks[-1])

    def counts(self, texts: list[str | None]) -> list[int]:
        """Of a batch: pieces that are not known are encoded together."""
        fresh: set[str] = set()
        cut: list[list[str] | None] = []
        self.forget()
        for t in texts:
            cut.append(self.pieces(t) if t and len(t) <= self.chunk else None)
            if cut[-1]:
                fresh.update(cut[-1])
        self.learn(fresh)
        known = self.known.__getitem__
        done = [None if c is None else sum(map(known, c)) for c in cut]
        # the others come after them, since they may make the cache forget
        return [n if n is not None else self.count(t) if t else 0 for t, n in zip(texts, done, strict=True)]


def token_counts(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; one pass, no shuffle."""
    def make():
        counter = Counter(tokenizer, chunk, overlap)

        def kernel(texts):
            sizes = [len(t.encode()) if t else 0 for t in texts]
            tokens: list[int] = []
            group: list = []
            held = 0
            for t in texts:  # a few megabytes of text at a time
                group.append(t)
                held += len(t or "")
                if held > 4_000_000:
                    tokens += counter.counts(group)
                    group, held = [], 0
            tokens += counter.counts(group)
            return [sizes, tokens, [n > limit for n in tokens]]
        return kernel
    return map_texts(docs, text, [doc_id], [field("n_bytes", "long"), field("n_tokens", "long"),
                                            field("over_limit", "boolean")], make, as_bytes=False).toDF(
        "doc_id", "n_bytes", "n_tokens", "over_limit")
