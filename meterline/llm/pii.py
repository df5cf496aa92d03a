"""Personal data: fixed patterns, and a skip-chain conditional random field over their tokens.

Fixed patterns give ``email``, ``ip``, ``card`` and ``phone`` spans. The field labels tokens with
one of these kinds or none. Only tokens that hold a digit or an ``@`` are its nodes: any other
token cannot carry a kind and is fixed to none. Neighbouring nodes share a transition potential.
Distant nodes share a skip potential if they are the same after all but letters and digits has gone
(or the same up to their country prefix): each is tied to the next such one, so the skip edges of a
document are at most its nodes, however often a token repeats. Marginals come from loopy
sum-product message passing with a fixed number of damped rounds. A number that the patterns find
once, say with its ``+``, so pulls its other occurrences along if their context allows it.

Training (piecewise, on a bounded sample of whole documents, labels from the fixed patterns): the unary
part is a maximum-entropy model over token shape and context features, none of which is the
patterns' verdict; the transition and skip parts are log ratios of how often labels meet on such an
edge to how often they would by chance. At inference, nodes in fixed spans are observed.

A run of nodes of one kind whose marginals reach ``SURE`` and that carries enough digits becomes a
span. Fixed spans always stay; added spans never overlap them.

Defined cases: null text is empty; an empty text has no spans. A table without any fixed span gives
a field that adds nothing. Positions are code points, ends exclusive. Repeated rows are each returned.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import map_rows, sha256_hex, thinned

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

#: Fixed patterns, by the query's contract. An e-mail address is sought from its @.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match that fails from a run's first digit fails from its others too, so only the first is tried.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Documents the field is trained on at most, and sets of features and label from them (expected numbers).
TRAIN_DOCS = 3000
TRAIN_ROWS = 100_000
#: Message rounds, damping, the marginal a token needs, digits an added span needs.
ROUNDS = 8
DAMPING = 0.5
SURE = 0.9
DIGITS = {"email": 0, "ip": 4, "card": 13, "phone": 8}


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if place % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def fixed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind as listed, then start."""
    out = []
    at = text.find("@")
    free = 0
    while at >= 0:
        m = DOMAIN.match(text, at + 1)
        if m:
            start = at
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                free = m.end()
                out.append(("email", start, free))
        at = text.find("@", max(at + 1, free))
    for m in IP.finditer(text):
        if all(int(p[-18:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        own = _digits(m.group())
        if 16 <= len(own) <= 19 and luhn(own):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


# ---- the field --------------------------------------------------------------------------

TOKEN = re.compile(r"\S+")
MARK = re.compile(r"[0-9@]")
FEATURES = 1 << 12


def nodes_of(text: str) -> list[tuple[int, int, str]]:
    """Tokens that can carry a kind, without enclosing punctuation."""
    out = []
    for m in TOKEN.finditer(text):
        if not MARK.search(text, m.start(), m.end()):
            continue
        own = m.group().strip(".,;:!?\"'|<>[]{}")
        if own:
            start = m.start() + m.group().index(own)
            out.append((start, start + len(own), own))
    return out


def _shape(token: str) -> str:
    kinds = ["d" if c.isdigit() else "a" if c.isalpha() else c for c in token[:48]]
    return "".join(c for i, c in enumerate(kinds) if i == 0 or c != kinds[i - 1])


def _hashed(name: str) -> int:
    h = 0
    for c in name.encode():
        h = (h * 0x01000193 ^ c) & 0xFFFFFFFF
    return (h ^ h >> 15) % FEATURES


def features(text: str, nodes: list[tuple[int, int, str]], i: int) -> list[int]:
    start, _, token = nodes[i]
    digits = _digits(token)
    before = text[max(0, start - 24) : start].split()
    names = [
        "bias",
        "shape=" + _shape(token),
        f"digits={min(len(digits), 20)}",
        f"luhn={len(digits) >= 13 and luhn(digits)}",
        f"at={token.count('@')}",
        f"dots={min(token.count('.'), 5)}",
        f"dashes={min(token.count('-'), 5)}",
        "first=" + token[0] if not token[0].isalnum() else "first=x",
        "cue=" + before[-1].lower()[:12] if before else "cue=",
        f"near={i > 0 and start - nodes[i - 1][1] <= 2}",
    ]
    return [_hashed(n) for n in names]


def skip_edges(nodes: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Each node tied to the next one of the same letters and digits, or of the same last ten digits."""
    last: dict[str, int] = {}
    out = set()
    for i, (_, _, token) in enumerate(nodes):
        own = "".join(c for c in token.lower() if c.isalnum())
        keys = ["=" + own] if len(own) > 3 else []
        if own.isdigit() and len(own) >= 10:
            keys.append("~" + own[-10:])
        for k in keys:
            if k in last:
                out.add((last[k], i))
            last[k] = i
    return sorted(out)


def node_labels(nodes: list[tuple[int, int, str]], fixed: list[tuple[str, int, int]]) -> list[int]:
    """Label of each node by the fixed spans it lies in (0: none)."""
    spans = sorted((a, b, KINDS.index(k) + 1) for k, a, b in fixed)
    out, at = [], 0
    for start, end, _ in nodes:
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        out.append(next((k for a, b, k in spans[at : at + 4] if a < end and b > start), 0))
    return out


NODE, CHAIN, SKIP = range(3)


def _counted(texts: Iterable[str]) -> Counter:
    """How often nodes of each features and label occur, and pairs of labels on chain and skip edges."""
    out: Counter = Counter()
    for text in texts:
        nodes = nodes_of(text)
        labels = node_labels(nodes, fixed_spans(text))
        out.update((NODE, tuple(features(text, nodes, i)), labels[i]) for i in range(len(nodes)))
        out.update(
            (CHAIN, (labels[i - 1], labels[i]), 0) for i in range(1, len(nodes)) if nodes[i][0] - nodes[i - 1][1] <= 2
        )
        out.update((SKIP, (labels[i], labels[j]), 0) for i, j in skip_edges(nodes))
    return out


class SkipChain:
    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    @classmethod
    def fit(cls, texts: list[str], rounds: int = 60) -> SkipChain:
        return cls.of_counts([(*key, n) for key, n in _counted(texts).items()], rounds)

    @classmethod
    def of_counts(cls, counts: list[tuple[int, tuple[int, ...], int, int]], rounds: int = 60) -> SkipChain:
        """Learns from counts as ``_counted`` gives them, in any order."""
        rows, y, seen, chain, skip = [], [], [], np.ones((5, 5)), np.ones((5, 5))
        for kind, key, label, n in sorted(counts):
            if kind == NODE:
                rows.append(key)
                y.append(label)
                seen.append(n)
            else:
                (chain if kind == CHAIN else skip)[key[0], key[1]] += n
        weight = np.zeros((FEATURES, 5))
        weight[_hashed("bias"), 0] = 4.0  # without any evidence: none
        if rows:
            x, y, n = np.array(rows), np.array(y), np.array(seen, float)[:, None]
            want = np.eye(5)[y]
            step = np.zeros_like(weight)
            for _ in range(rounds):  # full-batch ascent with per-weight steps
                score = weight[x].sum(axis=1)
                p = np.exp(score - score.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                grad = np.zeros_like(weight)
                for k in range(x.shape[1]):
                    np.add.at(grad, x[:, k], n * (want - p))
                grad -= 0.01 * weight
                step += grad * grad
                weight += 0.5 * grad / np.sqrt(step + 1e-8)

        def ratio(counts: np.ndarray) -> np.ndarray:
            joint = counts / counts.sum()
            chance = joint.sum(axis=1, keepdims=True) * joint.sum(axis=0, keepdims=True)
            return np.clip(np.log(joint / chance), -4.0, 4.0)

        return cls(weight, ratio(chain), ratio(skip))

    def marginals(self, text: str, nodes, observed: list[int]) -> np.ndarray:
        """Label marginals of the nodes by loopy sum-product; observed kinds are clamped."""
        n = len(nodes)
        unary = self.unary[np.array([features(text, nodes, i) for i in range(n)])].sum(axis=1)
        for i, k in enumerate(observed):
            if k:
                unary[i] = np.where(np.arange(5) == k, 0.0, -50.0)
        edges = [(i - 1, i, 0) for i in range(1, n) if nodes[i][0] - nodes[i - 1][1] <= 2]
        edges += [(i, j, 1) for i, j in skip_edges(nodes)]
        if edges:
            a = np.array([(i, j) for i, j, _ in edges] + [(j, i) for i, j, _ in edges])
            own = [self.skip if kind else self.chain for *_, kind in edges]
            table = np.exp(np.array(own + [t.T for t in own]))
            back = np.r_[np.arange(len(edges)) + len(edges), np.arange(len(edges))]
            message = np.zeros((len(a), 5))
            for _ in range(ROUNDS):
                belief = unary.copy()
                np.add.at(belief, a[:, 1], message)
                out = belief[a[:, 0]] - message[back]
                out -= out.max(axis=1, keepdims=True)
                new = np.log(np.einsum("ek,ekl->el", np.exp(out), table))
                new -= new.max(axis=1, keepdims=True)
                message = DAMPING * message + (1 - DAMPING) * new
            np.add.at(unary, a[:, 1], message)
        p = np.exp(unary - unary.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def added(self, text: str, fixed: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        nodes = nodes_of(text)
        if not nodes:
            return []
        observed = node_labels(nodes, fixed)
        if all(observed):
            return []
        p = self.marginals(text, nodes, observed)
        out: list[tuple[str, int, int]] = []
        run: tuple[int, int, int] | None = None
        for i, (start, end, _) in enumerate(nodes):
            k = int(p[i].argmax())
            if observed[i] or not k or p[i, k] < SURE:
                k = 0
            if run and (k != run[0] or start - run[2] > 2):
                out.append((KINDS[run[0] - 1], run[1], run[2]))
                run = None
            if k:
                run = (k, run[1] if run else start, end)
        if run:
            out.append((KINDS[run[0] - 1], run[1], run[2]))
        return [(k, a, b) for k, a, b in out if len(_digits(text[a:b])) >= DIGITS[k] and (k != "email" or "@" in text[a:b])]


def _join(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _ordered(spans):
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


def train(docs: DataFrame, id_col="doc_id", text_col="text", limit: int = TRAIN_DOCS) -> SkipChain:
    """The field of about ``limit`` whole documents with digits at most, those of the lowest hashes.

    Tasks read the texts; what comes to the driver are counts, of about ``TRAIN_ROWS`` different sets of features at most.
    """
    some = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    some = thinned(some.filter("text rlike '[0-9][0-9]'"), limit, "id", "text").select("text")

    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (text,) in rows:
            for (kind, key, label), n in _counted([text]).items():
                yield kind, list(key), label, n

    counts = map_rows(some, step, "kind int, key array<int>, label int, n long")
    counts = counts.groupBy("kind", "key", "label").agg(F.sum("n").alias("n")).persist()
    nodes = thinned(counts.filter(f"kind = {NODE}"), TRAIN_ROWS, "key", "label")
    found = nodes.union(counts.filter(f"kind <> {NODE}")).collect()
    counts.unpersist()
    return SkipChain.of_counts([(r["kind"], tuple(r["key"]), r["label"], r["n"]) for r in found])


def _scan_step(field):
    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        model = field.value
        for doc_id, text in rows:
            text = text or ""
            fixed = fixed_spans(text)
            yield doc_id, fixed, model.added(text, fixed)

    return step


def scan(docs: DataFrame, field: SkipChain | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, spans``: array of kind, start, end, fixed."""
    shared = docs.sparkSession.sparkContext.broadcast(field or train(docs, id_col, text_col))

    def step(rows):
        for doc_id, fixed, more in _scan_step(shared)(rows):
            every = _ordered([(*s, True) for s in fixed] + [(*s, False) for s in more])
            yield doc_id, [dict(zip(("kind", "start", "end", "fixed"), s, strict=True)) for s in every]

    own = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return map_rows(own, step, "doc_id long, spans array<struct<kind:string,start:int,end:int,fixed:boolean>>")


def scan_digests(docs: DataFrame, field: SkipChain | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(field or train(docs, id_col, text_col))

    def step(rows):
        for doc_id, fixed, more in _scan_step(shared)(rows):
            count = [sum(s[0] == k for s in fixed) for k in KINDS]
            yield doc_id, *count, sha256_hex(_join(fixed).encode()), _join(_ordered(fixed + more))

    own = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_rows(own, step, schema)
