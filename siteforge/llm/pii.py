"""Personal data: exact base patterns, then a skip-chain conditional random field that adds what is consistent with them.

Base spans (email, ip, card, phone) follow fixed patterns and checks and are never changed. The field's nodes are the base spans, whose
label is observed, and the open rest: runs of neighbouring tokens of digits and number punctuation, and other tokens with a digit or
an @. Neighbouring nodes share a chain potential. Nodes that are alike, however far apart, share a skip potential: the same normalised
form, the same last nine digits once joined (so a spaced number meets its compact spelling), or the same mailbox without its tag at any
domain. Loopy belief propagation over the whole document gives each open node's label; it runs in every document with an open
node, and unary weights decide where nothing is observed. An open node becomes a further span if its label's marginal is over SURE,
so a number or address found once is found in its other spellings. Unary weights are trained by logistic regression (piecewise
training) on the base labels of a bounded sample of documents; the chain and skip weights are the log odds of agreement.

Nulls: a null text is treated as empty. Repeated rows each get their row; ties in a marginal are not entities. An empty table gives an
empty result, columns of the operator's names are replaced, and all patterns run in time linear in the text, as whole texts are read.
"""
from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteforge.llm.common import frugal, read, widened

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 1000
#: Texts over so many characters are not learnt from, which bounds the sample's bytes.
SAMPLE_CHARS = 50_000
SURE = 0.9
SKIP_PRIOR = 1000
EPOCHS, RATE, ROUNDS, DAMPING = 200, 0.5, 20, 0.3
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NODE = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_NUMBER = re.compile(r"[0-9+(][0-9().+/-]*+[,;:!?]?\Z")
_CUE = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    out, at, done = [], text.find("@"), 0
    while at >= 0:
        m = _DOMAIN.match(text, at + 1) if at > done and text[at - 1] in _LOCAL_CHARS else None
        if m:
            start = at
            while start > done and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            done = m.end()
            out.append((start, done))
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)
    return out


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for c in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in emails(text)]
    if not _CUE.search(text):
        return out
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p := x.lstrip("0")) <= 3 and int(p or "0") <= 255 for x in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        d = _DIGITS.sub("", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _band(n: int) -> int:
    return sum(n >= x for x in (1, 4, 7, 10, 14, 16, 20))


def _features(token: str) -> list[int]:
    """Indices of a token's shape features; the first is the bias."""
    digits, letters = sum(c.isdigit() for c in token), sum(c.isalpha() for c in token)
    at = token.find("@")
    return [
        0,
        1 + _band(digits),
        9 + min(token.count("."), 4),
        14 + min(token.count("-"), 3),
        18 + (at > 0) + (at > 0 and "." in token[at:]),
        21 + (token[:1] in "+("),
        23 + (letters > 0) + (letters > digits),
        26 + min(4, len(token) // 8),
    ]


N_FEATURES = 31


def graph(text: str, base: list[tuple[int, int, int]]):
    """Nodes (start, end, label: 1 + kind if observed, else 0), chain edges, skip edges."""
    nodes, chain, alike = [], [], {}
    runs: list[list] = [[s, e, k + 1, False] for s, k, e in base]
    i, spans, gap = 0, sorted((s, e) for s, _, e in base), None
    for m in _NODE.finditer(text):
        s, e = m.span()
        while i < len(spans) and spans[i][1] <= s:
            i += 1
        if i < len(spans) and spans[i][0] < e:
            gap = None
            continue  # it is part of a base span
        number = _NUMBER.match(m[0]) is not None
        if number and gap is not None and runs[gap][3] and text[runs[gap][1] : s].isspace() and "\n" not in text[runs[gap][1] : s]:
            runs[gap][1] = e
        else:
            gap = len(runs)
            runs.append([s, e, 0, number])
    before = -1
    for n, (s, e, label, _) in enumerate(sorted(runs, key=lambda r: r[:3])):
        nodes.append((s, e, label))
        if before >= 0 and text[nodes[before][1] : s].strip() == "":
            chain.append((before, n))
        before = n
        form = text[s:e].strip(".,;:!?()[]{}<>\"'").lower()
        digits = _DIGITS.sub("", form)
        box = form.partition("@")[0].partition("+")[0] if "@" in form else ""
        for key in (form, "#" + digits[-9:] if len(digits) >= 9 else None, "@" + box if len(box) >= 3 else None):
            if key:
                alike.setdefault(key, []).append(n)
    skip = set()
    for members in alike.values():  # to the first observed one, else each to the one before
        first = next((i for i in members if nodes[i][2]), None)
        skip.update((min(first, i), max(first, i)) for i in members if i != first) if first is not None else skip.update(zip(members, members[1:]))
    return nodes, chain, sorted(skip)


def train(texts: list[str]) -> tuple[np.ndarray, float, float]:
    """Node weights (features x labels), chain weight, skip weight.

    An open node that is alike an observed one is of unknown label: it trains nothing. Weights of edges count observed pairs only, skip
    edges with SKIP_PRIOR pairs that agree and one that does not beforehand.
    """
    rows, labels, agree = [], [], {"chain": [1, 1], "skip": [SKIP_PRIOR, 1]}
    for text in texts:
        nodes, chain, skip = graph(text, base_spans(text))
        unknown = {i for a, b in skip for i, j in ((a, b), (b, a)) if not nodes[i][2] and nodes[j][2]}
        for i, (s, e, y) in enumerate(nodes):
            if i not in unknown:
                rows.append(_features(text[s:e]))
                labels.append(y)
        for name, edges in (("chain", chain), ("skip", skip)):
            for a, b in edges:
                if nodes[a][2] and nodes[b][2]:
                    agree[name][nodes[a][2] != nodes[b][2]] += 1
    w = np.zeros((N_FEATURES, len(KINDS) + 1))
    if rows:
        x = np.zeros((len(rows), N_FEATURES))
        for f in np.array(rows).T:
            x[np.arange(len(rows)), f] = 1
        y = np.eye(len(KINDS) + 1)[labels]
        for _ in range(EPOCHS):
            z = x @ w
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            w += RATE * (x.T @ (y - p) / len(rows) - 1e-4 * w)
    odds = {k: float(np.clip(np.log(a / d), 0, 8)) for k, (a, d) in agree.items()}
    return w, odds["chain"], odds["skip"]


def marginals(local: np.ndarray, edges: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Loopy sum-product: label probabilities of each node. An edge multiplies equal labels by exp(weight)."""
    belief = lambda z: (p := np.exp(z - z.max(1, keepdims=True))) / p.sum(1, keepdims=True)
    if not len(edges):
        return belief(local)
    src, dst = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    more = np.expm1(np.concatenate([weight, weight]))[:, None]
    msg = np.zeros((len(src), local.shape[1]))
    for _ in range(rounds):
        total = local.copy()
        np.add.at(total, dst, msg)
        out = np.log1p(more * belief(total[src] - msg[back]))  # sum over the source's labels: 1 + (e^w - 1) p
        out -= out.mean(1, keepdims=True)
        new = DAMPING * msg + (1 - DAMPING) * out
        moved, msg = np.abs(new - msg).max(), new
        if moved < 1e-4:
            break
    total = local.copy()
    np.add.at(total, dst, msg)
    return belief(total)


def all_spans(text: str, model) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base, base and added) spans."""
    base = base_spans(text)
    if not _CUE.search(text):  # no node
        return base, base
    nodes, chain, skip = graph(text, base)
    if all(n[2] for n in nodes):
        return base, base
    w, w_chain, w_skip = model
    local = w[np.array([_features(text[s:e]) for s, e, _ in nodes])].sum(1)
    for i, (_, _, y) in enumerate(nodes):
        if y:
            local[i] = -30.0
            local[i, y] = 30.0
    edges = np.array(chain + skip, dtype=np.int64).reshape(-1, 2)
    p = marginals(local, edges, np.array([w_chain] * len(chain) + [w_skip] * len(skip)))
    added = []
    for (s, e, y), q in zip(nodes, p):
        k = int(q.argmax())
        if not y and k and q[k] > SURE:
            token = text[s:e]
            s += len(token) - len(token.lstrip(".,;:!?()[]{}<>\"'"))
            e -= len(token) - len(token.rstrip(".,;:!?()[]{}<>\"'"))
            if s < e:
                added.append((s, k - 1, e))
    return base, sorted(base + added)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """text with each run of overlapping spans replaced by the kind of its first."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def fit(docs: DataFrame, sample: int = SAMPLE_DOCS):
    """The model, from the base labels of at most `sample` texts, the first by hash among those with a digit or an @.

    The hashes choose the texts, so that only the chosen ones leave the executors, each once however often it occurs.
    """
    rows = docs.where(f"length(text) <= {SAMPLE_CHARS} and text rlike '[0-9@]'").select("text", F.xxhash64("text").alias("h"))
    top = rows.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    chosen = rows.where(F.col("h") <= top).groupBy("h").agg(F.min("text").alias("text")).orderBy("h") if top is not None else rows.where("false")
    return train([r.text for r in chosen.select("text").collect()])


def find(df: DataFrame, model) -> DataFrame:
    """df with n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added and masked (null for a null text)."""
    new = [*((f"n_{k}", "bigint") for k in KINDS), ("base_sha256", "string"), ("spans", "string"), ("n_added", "bigint"), ("n_spans", "bigint"), ("masked", "string")]
    df, schema = widened(df, new)

    def run(batches):
        for b in batches:
            cols: dict[str, list] = {c: [] for c, _ in new}
            for text in b["text"]:
                base, spans = all_spans(text or "", model)
                for i, k in enumerate(KINDS):
                    cols[f"n_{k}"].append(sum(x[1] == i for x in base))
                cols["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                cols["spans"].append(written(spans))
                cols["n_added"].append(len(spans) - len(base))
                cols["n_spans"].append(len(spans))
                cols["masked"].append(None if text is None else mask(text, spans) if spans else text)
            for c, t in new:
                b[c] = pd.Series(cols[c], index=b.index, dtype="int64" if t == "bigint" else object)
            yield b

    return df.mapInPandas(frugal(run), schema)


def op2_pii(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "text")
    return find(d, fit(d)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "n_spans")
