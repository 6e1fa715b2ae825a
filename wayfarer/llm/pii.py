"""Personal data by patterns and a skip-chain conditional random field.

Fixed patterns find the base spans. A CRF then labels the other number- and
address-like tokens of the document: its potentials are a token's shape, the
labels of its neighbours (chain), and the labels of distant tokens that repeat it
or resemble it (skip edges: the same letters and digits, the same last seven
digits, the same mailbox name). Tokens of base spans are observed; loopy message passing
carries their labels along the edges, so that a phone number given in full once is
also found where it is shortened. Base spans always stay as they are.

The weights are trained here by pseudo-likelihood, on a bounded sample of documents whose base
spans are the labels. Tokens with a key in common are linked in a chain, and each of them to the
key's hubs: the first observed token of each label, or the first token if none is observed. So an observed
label reaches every repeat in one step, and edges grow with the document, never with its square.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.llm import common as C

KINDS = ("email", "ip", "card", "phone")          # labels 1 to 4; 0 is none
# What the contract calls base spans.
_AFTER_AT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_MAILBOX = re.compile(r"[A-Za-z0-9._%+-]+@")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_DIGIT_OR_AT = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S+")
_EDGES = "\"'`.,;:!?()[]{}<>=|"
FIT_DOCS = 1000        # documents the weights are fitted on, at most
FIT_CHARS = 20000      # longest text among them
THRESHOLD = 0.9        # posterior that an added span needs
ROUNDS = 10            # of message passing


def luhn(digits: str) -> bool:
    odd = [int(d) for d in digits[-1::-2]]
    even = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(odd) + sum(d - 9 if d > 9 else d for d in even)) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ backwards: linear in any text."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        lo = at
        while lo > done and (text[lo - 1].isascii() and (text[lo - 1].isalnum() or text[lo - 1] in "._%+-")):
            lo -= 1
        if lo < at and (m := _AFTER_AT.match(text, at + 1)):
            out.append((lo, m.end()))
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1     # no match can reach over this @
            at = text.find("@", done)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind from 1, end) of the base spans, by start, then kind."""
    out = [(a, 1, b) for a, b in _emails(text)]
    if not _DIGIT_OR_AT.search(text):
        return out
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), 2, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 40:
            digits = re.sub("[ -]", "", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 3, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            out.append((m.start(), 4, m.end()))
    return sorted(out)


class Graph:
    """Nodes (base spans and other candidate tokens) of a text, and their edges."""

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        spans = [(a, b, kind) for a, kind, b in base]
        names = {text[a:b].split("@")[0].lower() for a, kind, b in base if kind == 1}
        taken = sorted((a, b) for a, b, _ in spans)
        self.nodes: list[tuple[int, int, int]] = list(spans)
        i = 0
        for m in _TOKEN.finditer(text):
            a, b = m.span()
            while a < b and text[a] in _EDGES:
                a += 1
            while b > a and text[b - 1] in _EDGES:
                b -= 1
            while i < len(taken) and taken[i][1] <= a:
                i += 1
            if a == b or i < len(taken) and taken[i][0] < b:
                continue
            word = text[a:b]
            if _DIGIT_OR_AT.search(word) or word.lower() in names:
                self.nodes.append((a, b, 0))
        self.nodes.sort()
        self.label = np.array([k for *_, k in self.nodes], np.int64)
        self.features = np.array([shape(text, a, b, self.nodes[j - 1][1] if j else 0)
                                  for j, (a, b, _) in enumerate(self.nodes)])
        found = [list(keys(text[a:b])) for a, b, _ in self.nodes]
        first: dict[str, int] = {}
        hubs: dict[str, dict[int, int]] = {}     # key -> label -> its first token
        for j, (*_, kind) in enumerate(self.nodes):
            for key in found[j]:
                first.setdefault(key, j)
                if kind:
                    hubs.setdefault(key, {}).setdefault(kind, j)
        last: dict[str, int] = {}
        skip: set[tuple[int, int]] = set()
        for j, mine in enumerate(found):
            for key in mine:
                around = list(hubs[key].values()) if key in hubs else [first[key]]
                for other in (*around, last.get(key, j)):
                    if other != j:
                        skip.add((min(j, other), max(j, other)))
                last[key] = j
        near = [(j, j + 1) for j in range(len(self.nodes) - 1)
                if self.nodes[j + 1][0] - self.nodes[j][1] <= 40 and (j, j + 1) not in skip]
        self.edges = np.array(near + sorted(skip), np.int64).reshape(-1, 2)
        self.skip = np.arange(len(self.edges)) >= len(near)


def keys(word: str) -> Iterator[str]:
    """Tokens that have a key in common repeat or resemble each other."""
    plain = re.sub(r"[^0-9a-z]", "", word.lower())
    yield plain
    digits = re.sub(r"[^0-9]", "", word)
    if len(digits) >= 7 and not re.search("[A-Za-z]", word):
        yield "tail " + digits[-7:]
    if "@" in word:
        yield re.sub(r"[^0-9a-z]", "", word.split("@")[0].lower())


def shape(text: str, a: int, b: int, before: int) -> list[float]:
    word = text[a:b]
    digits = re.sub("[^0-9]", "", word)
    n = len(digits)
    parts = word.split(".")
    return [1.0, "@" in word, word[:1] == "+", "(" in word or ")" in word, "-" in word, " " in word,
            bool(re.search("[A-Za-z]", word)), word.isdigit(), len(parts) == 4, n == 0, n < 4, 4 <= n < 8,
            7 <= n < 9, 9 <= n < 12, 12 <= n <= 19, n > 19, 12 <= n <= 19 and luhn(digits),
            len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts),
            bool(_MAILBOX.match(word)), a - before > 40]


N_FEATURES = len(shape("x", 0, 1, 0))
N_LABELS = len(KINDS) + 1


def fit(graphs: list[Graph], steps: int = 300, decay: float = 1e-3) -> dict[str, np.ndarray]:
    """Weights by gradient ascent on the pseudo-likelihood of the observed labels.

    Every node counts twice, once with its shape hidden. Base shapes alone tell base labels, so
    only then do the edges learn what they say about a token of another shape."""
    unary = np.zeros((N_FEATURES, N_LABELS))
    pair = np.zeros((2, N_LABELS, N_LABELS))     # chain, skip; symmetric
    graphs = [g for g in graphs if len(g.nodes)]
    if not graphs:
        return {"unary": unary, "pair": pair}
    x = np.concatenate([g.features for g in graphs])
    y = np.eye(N_LABELS)[np.concatenate([g.label for g in graphs])]
    base = np.cumsum([0] + [len(g.nodes) for g in graphs])
    edges = np.concatenate([g.edges + o for g, o in zip(graphs, base, strict=False)])
    skip = np.concatenate([g.skip for g in graphs])
    around = np.zeros((2, len(y), N_LABELS))     # labels beside each node, per kind of edge
    for kind in (0, 1):
        a, b = edges[skip == kind].T
        np.add.at(around[kind], a, y[b])
        np.add.at(around[kind], b, y[a])
    x, y = np.concatenate([x, np.zeros_like(x)]), np.concatenate([y, y])
    around = np.concatenate([around, around], axis=1)
    square = [np.zeros_like(unary), np.zeros_like(pair)]
    for _ in range(steps):
        score = x @ unary + np.einsum("kni,kij->nj", around, pair)
        p = np.exp(score - score.max(1, keepdims=True))
        error = y - p / p.sum(1, keepdims=True)
        to_pair = np.einsum("kni,nj->kij", around, error)
        grads = [x.T @ error / len(y) - decay * unary,
                 (to_pair + to_pair.transpose(0, 2, 1)) / 2 / len(y) - decay * pair]
        for w, g, s in zip((unary, pair), grads, square, strict=True):
            s += g * g
            w += 0.5 * g / (np.sqrt(s) + 1e-8)
    return {"unary": unary, "pair": pair}


def posterior(g: Graph, weights: dict[str, np.ndarray]) -> np.ndarray:
    """Label probabilities by loopy belief propagation, base labels observed."""
    score = g.features @ weights["unary"]
    seen = g.label > 0
    score[seen] = -1e4
    score[seen, g.label[seen]] = 0
    if not len(g.edges):
        score -= score.max(1, keepdims=True)
        p = np.exp(score)
        return p / p.sum(1, keepdims=True)
    src = np.concatenate([g.edges[:, 0], g.edges[:, 1]])
    dst = np.concatenate([g.edges[:, 1], g.edges[:, 0]])
    table = weights["pair"][np.concatenate([g.skip, g.skip]).astype(int)]
    back = np.concatenate([np.arange(len(g.edges)) + len(g.edges), np.arange(len(g.edges))])
    message = np.zeros((len(src), N_LABELS))
    for _ in range(ROUNDS):
        belief = score.copy()
        np.add.at(belief, dst, message)
        out = (belief[src] - message[back])[:, :, None] + table
        top = out.max(1, keepdims=True)
        new = (top + np.log(np.exp(out - top).sum(1, keepdims=True)))[:, 0]
        message = new - new.max(1, keepdims=True)
    belief = score.copy()
    np.add.at(belief, dst, message)
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added(text: str, base: list[tuple[int, int, int]], weights) -> list[tuple[int, int, int]]:
    if not base:
        return []      # nothing is observed that labels could follow from
    g = Graph(text, base)
    free = g.label == 0
    if not free.any():
        return []
    p = posterior(g, weights)
    p[:, 0] = 0
    best = p.argmax(1)
    linked = np.zeros(len(free), bool)          # tokens that repeat or resemble another one
    linked[g.edges[g.skip].ravel()] = True
    pick = np.flatnonzero(free & linked & (p.max(1) >= THRESHOLD))
    return [(g.nodes[j][0], int(best[j]), g.nodes[j][1]) for j in pick]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(_SPAN)), ("spans", pa.list_(_SPAN))])
_DDL = ("doc_id long, base array<struct<kind:string,start:long,stop:long>>, "
        "spans array<struct<kind:string,start:long,stop:long>>")


def _find(batches: Iterator[pa.RecordBatch], weights) -> Iterator[pa.RecordBatch]:
    def row(spans):
        return [{"kind": KINDS[k - 1], "start": a, "stop": b} for a, k, b in spans]

    for part in C.slices(batches, "text"):
        base, spans = [], []
        for text in part.column("text").to_pylist():
            found = base_spans(text or "")
            base.append(row(found))
            spans.append(row(sorted(found + added(text, found, weights))) if found else [])
        yield C.arrow_rows({"doc_id": part.column("doc_id"), "base": base, "spans": spans}, _SCHEMA)


def train(docs: DataFrame, *, text: str = "text", fit_docs: int = FIT_DOCS) -> dict[str, np.ndarray]:
    """CRF weights from at most ``fit_docs`` documents of up to 20,000 characters that
    hold a digit, drawn by hash; their base spans are the labels."""
    t = F.col(text)
    able = (docs.where(t.rlike("[0-9]") & (F.length(t) <= FIT_CHARS))
            .select(t.alias("t"), F.xxhash64(t).alias("draw")))
    # Cut by hash before the sort, or every task would send its first fit_docs texts.
    cut = 4.0 * fit_docs / max(1, able.count())
    rows = (able.where(F.col("draw") / F.lit(2.0 ** 64) + 0.5 < cut)
            .orderBy("draw", "t").limit(fit_docs).collect())
    return fit([Graph(r.t, base_spans(r.t)) for r in rows])


def find_pii(docs: DataFrame, weights: dict[str, np.ndarray] | None = None, *,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, ``base`` (pattern spans) and ``spans`` (base and
    added ones), arrays of kind, start, stop in code points, by start, then kind.

    Null and empty texts have no spans; repeated rows have the same ones; a document
    without a base span gets none added. Other columns are not read.
    """
    weights = weights or train(docs, text=text)
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(lambda it: _find(it, weights), _DDL))


def digest(found: DataFrame) -> DataFrame:
    """The columns of query op9 from ``find_pii``."""
    def joined(column):
        return F.concat_ws(",", F.transform(column, lambda s: F.concat_ws(
            ":", s.kind, s.start.cast("string"), s.stop.cast("string"))))

    def count(kind):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"),
                        joined("spans").alias("spans"))
