"""Language ID by prediction by partial matching (PPM).

Each language has a context tree over bytes, orders 3 to 0. A byte seen after
a context with count c has probability c / (T + D) there (T: bytes seen after
the context, D: distinct ones); an unseen byte pays the escape D / (T + D) and
is coded by the next shorter context, without the bytes the escape rules out
(their probability is taken out and the rest scaled up); below order 0 all
bytes are alike. Statistics are frozen after the fit, so a text's exact code
length under each language is a sum of table values. The shortest code wins;
the score is its share of 2 ** -length over all languages.

Bytes: A-Z are lower-cased, runs of other ASCII characters than letters become
one space. All 256 byte values are symbols of their own.

The trees of all languages are kept as hashed tables of the strings that occur
in the sample (4 bytes: a byte after three; 3 bytes: a byte after two, and the
escape from three), with one column a language; orders 1 and 0 are small enough
to be dense. A string that is not in a table is coded by the next shorter one.

The fit takes a bounded sample: of each language about ``per_lang`` rows
(a parameter), chosen by a hash of the id; their 4-byte counts are summed in
Spark, and what reaches the driver is one row per language and distinct
4-gram. Scoring reads every text whole, in slices; nothing is shuffled.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is everything if no row can be learned from. Rows without a language are
predicted but never learned from. Ties go to the alphabetically first language.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import field, fresh, labelled_sample, map_texts, quoted, share

UND = "und"
#: Rows of each language that the fit may read (an expected bound).
PER_LANG = 2000
_SLICE = 1 << 18
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_START = b"   "


def symbols(text: bytes) -> bytes:
    """Lower-cased letters, single spaces, three spaces of context in front."""
    return _START + b" ".join(text.translate(_TABLE).split()) + b" "


def has_letter(text: bytes) -> bool:
    return bool(re.search(rb"[A-Za-z]", text)) or (
        not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace"))))


def _grams(data: np.ndarray) -> np.ndarray:
    d = data.astype(np.uint32)
    return (d[:-3] << 24) | (d[1:-2] << 16) | (d[2:-1] << 8) | d[3:]


def gram_counts(sample: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, gram, n): 4-byte strings of the sample, summed map side first."""
    src = sample.select(quoted(lang).cast("string").alias("lang"), quoted(text).cast("binary").alias("body"))

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            by: dict[str, list] = {}
            for lang_, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if body and has_letter(body):
                    by.setdefault(lang_, []).append(_grams(np.frombuffer(symbols(body), np.uint8)))
            for lang_, parts in by.items():
                gram, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang_] * len(gram)), pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"])
    return src.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Index:
    """A hash table of 32-bit keys: ``find`` gives a key's row, 0 if it has none."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.concatenate([np.zeros(1, np.uint32), keys.astype(np.uint32)])
        bits = max(8, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint32(32 - bits), (1 << bits) - 1
        self.slots = np.zeros(1 << bits, np.int32)
        row, at = np.arange(1, len(self.keys), dtype=np.int32), self._at(self.keys[1:])
        while len(row):
            free = self.slots[at] == 0
            self.slots[at[free]] = row[free]
            left = self.slots[at] != row
            row, at = row[left], (at[left] + 1) & self.mask

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._at(keys)
        row = self.slots[at]
        miss = np.flatnonzero((row > 0) & (self.keys[row] != keys))
        at, key = at[miss], keys[miss]
        while len(miss):
            at = (at + 1) & self.mask
            row[miss] = self.slots[at]
            wrong = (row[miss] > 0) & (self.keys[row[miss]] != key)
            miss, at, key = miss[wrong], at[wrong], key[wrong]
        return row


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out, back = np.unique(keys, return_inverse=True)
    return out, np.bincount(back, n, len(out))


class Ppm:
    """Code length tables of all languages, in bits. Row 0 of the tables of
    strings stands for strings that no language has."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({r[0] for r in rows})
        number = {x: i for i, x in enumerate(self.langs)}
        lang = np.array([number[r[0]] for r in rows], np.int64)
        gram = np.array([r[1] for r in rows], np.int64)
        n = np.array([r[2] for r in rows], np.float64)
        k, self.four, self.three = len(self.langs), Index(np.unique(gram)), Index(np.unique(
            np.concatenate([gram >> 8, gram & 0xFFFFFF])) if len(gram) else gram)
        one, back2 = np.zeros((1 << 16, k)), np.zeros((1 << 16, k))
        two, back3 = np.zeros((len(self.three.keys), k)), np.zeros((len(self.three.keys), k))
        three = np.zeros((len(self.four.keys), k))
        for i in range(k):
            own, cnt = gram[lang == i], n[lang == i]
            c1 = np.bincount(own & 0xFFFF, cnt, 1 << 16).reshape(256, 256)
            p0 = _blend(c1.sum(0, keepdims=True), np.full((1, 256), 1 / 256))  # order -1: all bytes alike
            p1 = _blend(c1, np.broadcast_to(p0, (256, 256))).ravel()
            one[:, i] = -np.log2(np.maximum(p1, 1e-30))
            # order 2: strings of three bytes seen in this language, then the others
            key, count = _sums(own & 0xFFFFFF, cnt)
            seen, back2[:, i] = _order(key >> 8, count, p1[key & 0xFFFF], 1 << 16)
            all3 = self.three.keys.astype(np.int64)
            two[:, i] = back2[all3 >> 8, i] + one[all3 & 0xFFFF, i]
            two[self.three.find(key.astype(np.uint32)), i] = seen
            # order 3; its contexts are rows of the table of three bytes
            ctx = self.three.find((own >> 8).astype(np.uint32)).astype(np.int64)
            last = self.three.find((own & 0xFFFFFF).astype(np.uint32))
            seen, back3[:, i] = _order(ctx, cnt, np.exp2(-two[last, i]), len(back3))
            all4 = self.four.keys.astype(np.int64)
            three[:, i] = back3[self.three.find((all4 >> 8).astype(np.uint32)), i] + two[
                self.three.find((all4 & 0xFFFFFF).astype(np.uint32)), i]
            three[self.four.find(own.astype(np.uint32)), i] = seen
        back3[0] = 0
        self.bits3, self.bits2, self.back3, self.back2, self.bits1 = (
            x.astype(np.float32) for x in (three, two, back3, back2, one))

    def _bits(self, key: np.ndarray) -> np.ndarray:
        """Code lengths of the last byte of each string of four bytes."""
        row = self.four.find(key)
        bits = self.bits3[row]
        new = np.flatnonzero(row == 0)
        if len(new):
            k3 = key[new] & np.uint32(0xFFFFFF)
            row = self.three.find(k3)
            lower = self.bits2[row]
            none = np.flatnonzero(row == 0)
            lower[none] = self.back2[k3[none] >> np.uint32(8)] + self.bits1[k3[none] & np.uint32(0xFFFF)]
            bits[new] = self.back3[self.three.find(key[new] >> np.uint32(8))] + lower
        return bits

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text under each language."""
        out = np.zeros((len(texts), len(self.langs)))
        group: list[bytes] = []
        owner: list[int] = []
        held = 0

        def flush():
            bits = self._bits(_grams(np.frombuffer(b"".join(group), np.uint8)))
            first = np.cumsum([0] + [len(g) for g in group])
            # the first three bytes of a slice are context only
            for i, a, b in zip(owner, first[:-1].tolist(), (first[1:] - 3).tolist(), strict=True):
                out[i] += bits[a:b].sum(0, dtype=np.float64)
        for i, t in enumerate(texts):
            s = symbols(t)
            for lo in range(3, len(s), _SLICE):
                part = s[lo - 3:lo + _SLICE]
                group.append(part)
                owner.append(i)
                held += len(part)
                if held >= _SLICE:
                    flush()
                    group, owner, held = [], [], 0
        if group:
            flush()
        return out


def _order(ctx: np.ndarray, count: np.ndarray, lower: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the seen (context, byte) pairs, and of each context's escape
    without the bytes it rules out; ``lower``: their shorter contexts' probabilities."""
    total, kinds, gone = (np.bincount(ctx, w, n) for w in (count, None, lower))
    with np.errstate(divide="ignore", invalid="ignore"):
        esc = np.where(total > 0, kinds / (total + kinds) / np.maximum(1 - gone, 1e-12), 1.0)
    return -np.log2(count / (total + kinds)[ctx]), -np.log2(np.maximum(esc, 1e-30))


def _blend(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities of every symbol after every context of one order."""
    total, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
    left = 1 - np.where(counts > 0, lower, 0).sum(1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        seen = counts / (total + kinds)
        unseen = kinds / (total + kinds) * lower / np.maximum(left, 1e-12)
    return np.where(total == 0, lower, np.where(counts > 0, seen, unseen))


def fit(docs: DataFrame, train, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        per_lang: int = PER_LANG) -> Ppm:
    """``train``: the condition of rows that may be learned from."""
    sample = labelled_sample(docs.where(train), lang, doc_id, per_lang)
    return Ppm([(r[0], r[1], r[2]) for r in gram_counts(sample, lang, text).collect()])


def _kernel(shared):
    def make():
        model = shared()

        def kernel(texts):
            n = len(texts)
            pred, score = [UND] * n, [0.0] * n
            live = [i for i, t in enumerate(texts) if t and has_letter(t)] if model.langs else []
            bits = model.lengths([texts[i] for i in live])
            for i, b in zip(live, bits, strict=True):
                best = int(np.argmin(b))
                pred[i] = model.langs[best]
                score[i] = float(1 / np.exp2(np.maximum(b[best] - b, -1000)).sum())
            return [pred, score]
        return kernel
    return make


def predict(docs: DataFrame, model: Ppm, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with (lang_pred, score) appended under fresh names."""
    shared = share(docs.sparkSession, model)
    return map_texts(docs, text, keep, [field(fresh(docs, "lang_pred"), "string"), field(fresh(docs, "score"), "double")],
                     _kernel(shared))


def keep_known(docs: DataFrame, train, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
               per_lang: int = PER_LANG) -> DataFrame:
    """The rows of ``docs`` whose text is in a known language, all columns
    unchanged: a text that is null or has no letter (``und``) goes. Where nothing
    can be learned from, every text with a letter stays."""
    body = fresh(docs, "body")
    model = fit(docs, train, doc_id, text, lang, per_lang)
    if not model.langs:
        return docs.where(quoted(text).rlike(r"\p{L}"))
    wide = docs.withColumn(body, quoted(text))
    out = predict(wide, model, docs.columns, body)
    pred, score = out.columns[-2:]
    return out.where(F.col(pred) != UND).drop(pred, score)
