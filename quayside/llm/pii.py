"""Personal data: base patterns, and a skip-chain conditional random field.

Base spans are found by patterns (email, ip, card, phone), leftmost and
non-overlapping per kind, in linear time: an email is looked for around each
``@``, a number only where a run of digits begins.

The field adds spans the patterns miss (a number or address mentioned again in
another form). Its nodes are the white-space-delimited tokens that hold a digit
or ``@``; every other token is fixed to "none", which is exact for the model
because no label allows it. Potentials: features of the token's shape; a chain
factor between tokens that stand next to each other; a skip factor between
tokens with equal keys anywhere in the text (equal tokens, or an equal tail of
seven digits or more, or an equal mail name), each joined to its next
occurrence, so the edges grow with the tokens and not with their pairs. Nodes in
a base span are evidence: their label is given. Sum-product messages run over
chain and skip edges, each text's until its own have settled; the damping grows
with the rounds, so they always do. A node with a label at ``least`` or more
becomes a span if it meets no base span; base spans always stay.

Weights are fitted by penalised pseudo-likelihood to base labels in about
``fit_rows`` rows (a parameter), chosen by a hash of the id. A token without a
base span that shares a key with one that has may be a mention the patterns
miss: it is no example of "none".
Equal training cases are counted in Spark; what reaches the driver is one row
per distinct case of the sample.

Defined cases: a null text is empty and has no spans; very long texts are taken
whole, a graph of their own; without training cases the field adds nothing; ties
of two labels go to the first kind; repeated rows get a row each; ids may be
null; other columns are ignored or kept, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import field, fresh, map_texts, quoted, share, small_batches

KINDS = ("email", "ip", "card", "phone")
FIT_ROWS, LEAST = 40_000, 0.9
#: Characters of texts whose graphs are held at a time; rounds, beside
#: four a node, before the damping grows.
_PART, _ROUNDS = 500_000, 30

_LOCAL = "".join(map(chr, range(48, 58))) + "".join(map(chr, range(65, 91))) + "".join(map(chr, range(97, 123))) + "._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_EDGE = ".,;:!?\"'()[]{}<>|*#$%&"


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    end, before, at = 0, -1, text.find("@")
    while at >= 0:
        lo = max(end, before + 1)
        part = text[lo:at]
        start = lo + len(part.rstrip(_LOCAL))
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            end = m.end()
        before, at = at, text.find("@", at + 1)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base spans, by start, then kind."""
    if not text:
        return []
    out = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                d = _digits(m.group())
                if 14 <= len(d) <= 19 and _luhn(d):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


# ------------------------------------------------------------- the field

N_LABELS = len(KINDS) + 1  # 0: none
_BINS = (1, 2, 4, 6, 7, 8, 10, 12, 14, 16, 20)
N_FEATURES = len(_BINS) + 13


def _features(token: str, alone_left: bool, alone_right: bool) -> int:
    """Shape features of a token, as a bit set."""
    d = _digits(token)
    n = len(d)
    rest = "".join(c for c in token if not "0" <= c <= "9")
    flags = [
        True, "@" in token, bool(_DOMAIN.search(token)), token.count(".") == 3 and rest == "...", token[:1] == "+",
        not rest, bool(rest) and not rest.strip(" ().-+"), any(c.isalpha() for c in rest), "-" in token,
        14 <= n <= 19 and _luhn(d), len(token) > 24, alone_left, alone_right]
    bins = [n >= b for b in _BINS]
    return sum(1 << i for i, f in enumerate(flags + bins) if f)


def _keys(token: str):
    yield token.lower()
    d = _digits(token)
    if len(d) >= 7:
        yield "#" + d[-7:]
    if "@" in token:
        name = token.split("@")[0].lower()
        if len(name) >= 3:
            yield name


class Nodes:
    """Nodes and edges of a batch of texts."""

    def __init__(self):
        self.text, self.start, self.end, self.feat, self.label = [], [], [], [], []
        self.chain, self.skip = [], []

    def add(self, i: int, text: str, base) -> None:
        last: dict[str, int] = {}
        before, before_end = -1, 0
        found = list(_TOKEN.finditer(text))
        k = 0
        spans = sorted(base)
        for j, m in enumerate(found):
            raw = m.group()
            token = raw.strip(_EDGE)
            if not token:
                before = -1
                continue
            a = m.start() + raw.index(token)
            b = a + len(token)
            node = len(self.text)
            near = before >= 0 and not text[before_end:m.start()].strip()
            after = j + 1 < len(found) and not text[m.end():found[j + 1].start()].strip()
            while k < len(spans) and spans[k][2] <= a and all(s[2] <= a for s in spans[k:k + 4]):
                k += 1
            label = next((kind + 1 for s, kind, e in spans[k:k + 8] if s < b and a < e), 0)
            self.text.append(i)
            self.start.append(a)
            self.end.append(b)
            self.feat.append(_features(token, not near, not after))
            self.label.append(label)
            if near:
                self.chain.append((before, node))
            linked = set()
            for key in _keys(token):
                if key in last and last[key] not in linked:
                    self.skip.append((last[key], node))
                    linked.add(last[key])
                last[key] = node
            before, before_end = node, m.end()


def _design(feat: np.ndarray) -> np.ndarray:
    return ((feat[:, None] >> np.arange(N_FEATURES)) & 1).astype(np.float64)


def unsure(nodes: Nodes) -> np.ndarray:
    """Nodes without a label that may be mentions all the same."""
    label = np.array(nodes.label, np.int64)
    out = np.zeros(len(label), bool)
    for a, b in nodes.skip:
        out[a] |= label[b] > 0
        out[b] |= label[a] > 0
    return out & (label == 0)


def neighbours(nodes: Nodes) -> np.ndarray:
    """Counts of the labels next to each node: chain left, chain right, skip.
    Nodes that may be missed mentions are not counted."""
    n = len(nodes.text)
    out = np.zeros((n, 3, N_LABELS), np.int64)
    label, open_ = np.array(nodes.label, np.int64), unsure(nodes)
    for left, right, edges in ((0, 1, nodes.chain), (2, 2, nodes.skip)):
        for a, b in edges:
            if not open_[a]:
                out[b, left, label[a]] += 1
            if not open_[b]:
                out[a, right, label[b]] += 1
    return out


class Field:
    """Weights: features by label, chain (left label, right label), skip."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    @classmethod
    def fit(cls, cases, penalty: float = 1e-3, steps: int = 400) -> Field | None:
        """cases: (features, label, the 15 counts of ``neighbours``, rows)."""
        if not cases:
            return None
        x = _design(np.array([c[0] for c in cases], np.int64))
        y = np.eye(N_LABELS)[[c[1] for c in cases]]
        nb = np.array([c[2] for c in cases], np.float64).reshape(-1, 3, N_LABELS)
        w = np.array([c[3] for c in cases], np.float64)
        w /= w.sum()
        parts = [np.zeros((N_FEATURES, N_LABELS)), np.zeros((N_LABELS, N_LABELS)), np.zeros((N_LABELS, N_LABELS))]
        m = [np.zeros_like(p) for p in parts]
        v = [np.zeros_like(p) for p in parts]
        for t in range(1, steps + 1):
            z = x @ parts[0] + nb[:, 0] @ parts[1] + nb[:, 1] @ parts[1].T + nb[:, 2] @ parts[2]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = (p - y) * w[:, None]
            grads = [x.T @ g, nb[:, 0].T @ g + (nb[:, 1].T @ g).T, nb[:, 2].T @ g]
            grads[2] = (grads[2] + grads[2].T) / 2  # the skip factor knows no direction
            for k in range(3):  # Adam
                grads[k] += penalty * parts[k]
                m[k] = 0.9 * m[k] + 0.1 * grads[k]
                v[k] = 0.999 * v[k] + 0.001 * grads[k] ** 2
                parts[k] -= 0.1 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-9)
        return cls(*parts)

    def marginals(self, nodes: Nodes, given: bool = False) -> np.ndarray:
        """Label probabilities by loopy sum-product on all edges; ``given``: the
        labels that nodes have are evidence."""
        unary = _design(np.array(nodes.feat, np.int64)) @ self.unary
        if given:
            label = np.array(nodes.label)
            known = np.flatnonzero(label > 0)
            unary[known] = -50.0
            unary[known, label[known]] = 50.0
        # messages along the chain, against it, and both ways of the skip edges
        pots = (self.chain, self.chain.T, self.skip, self.skip)
        pairs = [np.array(e, np.int64).reshape(-1, 2) for e in (nodes.chain, nodes.skip)]
        ways = [pairs[0], pairs[0][:, ::-1], pairs[1], pairs[1][:, ::-1]]
        text = np.array(nodes.text, np.int64)
        live = [np.arange(len(w)) for w in ways]
        msgs = [np.zeros((len(w), N_LABELS)) for w in ways]
        belief = unary.copy()
        done, patience = 0, _ROUNDS + 4 * np.bincount(text)  # evidence may have to pass every node
        while any(len(x) for x in live):
            steps = 0.5 * 0.9 ** np.maximum(0, done - patience)
            moved = np.zeros(text[-1] + 1)
            new = []
            for k, (way, pot) in enumerate(zip(ways, pots, strict=True)):
                at = live[k]
                out = belief[way[at, 0]] - msgs[k ^ 1][at]
                z = out[:, :, None] + pot
                top = z.max(1)
                m = np.log(np.exp(z - top[:, None]).sum(1)) + top
                m -= m.max(1, keepdims=True)
                step = steps[text[way[at, 0]], None]
                m = step * m + (1 - step) * msgs[k][at]
                np.maximum.at(moved, text[way[at, 0]], np.abs(m - msgs[k][at]).max(1, initial=0))
                new.append(m)
            belief = unary.copy()
            for k, way in enumerate(ways):
                msgs[k][live[k]] = new[k]
                np.add.at(belief, way[:, 1], msgs[k])
                live[k] = live[k][moved[text[way[live[k], 0]]] >= 1e-4]
            done += 1
        return _softmax(belief)


def _softmax(z):
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS) -> Field | None:
    """The field fitted to the base labels of a bounded sample of the rows."""
    small_batches(docs.sparkSession)
    total = docs.count()
    spread = 1 << 30
    src = docs.where(F.pmod(F.xxhash64(quoted(doc_id), F.lit("sample")), F.lit(spread))
                     < F.lit(spread * fit_rows / max(total, 1))).select(quoted(text).cast("string").alias("body"))

    def run(batches):
        for batch in batches:
            for part in _parts(batch.column(0).to_pylist()):
                nodes = Nodes()
                for i, t in enumerate(part):
                    if t:
                        nodes.add(i, t, base_spans(t))
                keep = np.flatnonzero(~unsure(nodes))
                nb = np.minimum(neighbours(nodes), 3).reshape(-1, 3 * N_LABELS)[keep]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.array(nodes.feat, np.int64)[keep]), pa.array(np.array(nodes.label, np.int32)[keep]),
                    pa.array(nb.tolist(), pa.list_(pa.int32()))], names=["feat", "label", "nb"])
    cases = (src.mapInArrow(run, "feat long, label int, nb array<int>").groupBy("feat", "label", "nb")
             .agg(F.count(F.lit(1)).alias("n")).orderBy("feat", "label", "nb").collect())
    return Field.fit([tuple(c) for c in cases])


def find(texts: list[str | None], model: Field | None, least: float = LEAST):
    """Of each text: its base spans and all spans, as (start, kind number, end)."""
    base = [base_spans(t) for t in texts]
    spans = [list(b) for b in base]
    if model is None:
        return base, spans
    nodes = Nodes()
    for i, t in enumerate(texts):
        if t and ("@" in t or _DIGIT.search(t)):
            nodes.add(i, t, base[i])
    if nodes.text:
        p = model.marginals(nodes, given=True)
        best = p.argmax(1)
        for k in np.flatnonzero((best > 0) & (p.max(1) >= least)).tolist():
            i, a, b = nodes.text[k], nodes.start[k], nodes.end[k]
            if nodes.label[k] == 0 and not any(s < b and a < e for s, _, e in base[i]):
                spans[i].append((a, int(best[k]) - 1, b))
    return base, [sorted(s) for s in spans]


def join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _parts(texts, most: int = _PART):
    """Runs of texts of a few megabytes, so one graph stays small."""
    lo = 0
    while lo < len(texts):
        hi, n = lo, 0
        while hi < len(texts) and (hi == lo or n + len(texts[hi] or "") <= most):
            n += len(texts[hi] or "")
            hi += 1
        yield texts[lo:hi]
        lo = hi


def scan(docs: DataFrame, model: Field | None, doc_id: str = "doc_id", text: str = "text",
         least: float = LEAST) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)."""
    shared = share(docs.sparkSession, model)

    def make():
        model = shared()

        def kernel(texts):
            n = [[], [], [], []]
            sha, spans = [], []
            for part in _parts(texts):
                for own, every in zip(*find(part, model, least), strict=True):
                    for k in range(4):
                        n[k].append(sum(s[1] == k for s in own))
                    sha.append(hashlib.sha256(join(own).encode()).hexdigest())
                    spans.append(join(every))
            return [*n, sha, spans]
        return kernel
    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    kinds = ["long"] * 4 + ["string"] * 2
    return map_texts(docs, text, [doc_id], [field(a, b) for a, b in zip(names, kinds, strict=True)], make,
                     as_bytes=False).toDF("doc_id", *names)


def redact(text: str | None, spans) -> str | None:
    """The text with each span (overlapping ones together) replaced by <KIND>."""
    if not text or not spans:
        return text
    out, right = [], 0
    for a, k, b in spans:
        if a >= right:
            out += [text[right:a], f"<{KINDS[k].upper()}>"]
        right = max(right, b)
    return "".join(out) + text[right:]


def redacted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str = "n_chars",
             fit_rows: int = FIT_ROWS, least: float = LEAST) -> DataFrame:
    """``docs`` with every span replaced in the text (and its length column,
    where there is one, set anew). All rows and columns stay."""
    shared = share(docs.sparkSession, fit(docs, doc_id, text, fit_rows))
    body, new = fresh(docs, "body"), fresh(docs, "new_text")

    def make():
        model = shared()

        def kernel(texts):
            out = []
            for part in _parts(texts):
                out += [redact(t, s) for t, s in zip(part, find(part, model, least)[1], strict=True)]
            return [out]
        return kernel
    rest = [c for c in docs.columns if c != text]
    done = map_texts(docs.withColumn(body, quoted(text)), body, rest, [field(new, "string")], make, as_bytes=False)
    size = {length: F.when(quoted(new).isNotNull(), F.char_length(quoted(new))).cast(docs.schema[length].dataType)
            } if length in docs.columns else {}
    return done.select(*[(quoted(new).alias(c) if c == text else size.get(c, quoted(c)).alias(c)) for c in docs.columns])
