"""Personal data: exact base patterns plus a semi-Markov conditional random field.

The base finds emails, IP addresses, cards and phone numbers by pattern. The field then
scores whole candidate segments (digit count, checksum, separators, groups, neighbours)
and a bounded-length dynamic programme picks the best joint segmentation of boundaries
and types; segments that overlap no base span are added. It is trained on windows whose
silver labels are the base spans, plus variants in formats the base does not know (no
country code, dotted card, masked at-sign) that keep the label.

Defined results: a null text is an empty text (no spans); a null id stays null; repeated
rows are scanned one by one; an empty table gives an empty result and, with no window to
learn from, a field that adds nothing; extra columns are ignored. Texts of any length are
scanned whole in time linear in their length: segments never leave a window (a maximal
run of number characters, or of address characters up to ``MAX_SIDE`` from an at-sign) and never
exceed ``MAX_ATOMS`` atoms. Of equally good segmentations the one with background, then with the
first kind, wins.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, keyed, text_bytes_conf

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]++\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]|[\[(]at[\])]")


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _small(part: str) -> bool:
    p = part.lstrip("0")
    return len(p) < 3 or (len(p) == 3 and p <= "255")


def _digits(s: str) -> str:
    return "".join(ch for ch in s if "0" <= ch <= "9")


def base_spans(text: str) -> list[Span]:
    """The contract's base spans, by kind as listed, then start. Emails are anchored at
    each at-sign, so a long run of address characters costs linear time."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > done and text[lo - 1] in _LOCAL_CHARS:
            lo -= 1
        m = _DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            out.append(("email", lo, m.end()))
            done = m.end()
        at = text.find("@", max(done, at + 1))
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
                if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
                if 8 <= len(_digits(m[0])) <= 15]
    return out


def render(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# --- the field -------------------------------------------------------------------------

#: Longest entity in atoms (digit runs, letter runs, single other characters).
MAX_ATOMS = 24
_NUMBERS = re.compile(r"[+(]?[0-9][0-9 ().+/-]*")
_RUN, _AT = re.compile(r"\S+"), re.compile(r"@|[\[(]at[\])]")
#: Characters before and after an at-sign between which the field looks for an address.
MAX_SIDE = 4096
_ATOM = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)
Window = tuple[int, int]


def windows(text: str) -> list[Window]:
    """Maximal runs that can hold an entity: number runs with at least 7 digits or three
    dots, and space-free runs around an at-sign. Overlapping runs are merged."""
    found = []
    for m in _NUMBERS.finditer(text):
        s = m[0].rstrip(" ().+/-")
        if len(s) >= 7 and (s.count(".") >= 3 or len(_digits(s)) >= 7):
            found.append((m.start(), m.start() + len(s)))
    if "@" in text or "[at]" in text or "(at)" in text:
        for run in _RUN.finditer(text):
            found += [(max(run.start(), m.start() - MAX_SIDE), min(run.end(), m.end() + MAX_SIDE))
                      for m in _AT.finditer(text, run.start(), run.end())]
    found.sort()
    out: list[Window] = []
    for a, b in found:
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _side(ch: str) -> str:
    return "edge" if not ch or ch.isspace() else "alpha" if ch.isalpha() else "digit" if ch.isdigit() \
        else "plus" if ch == "+" else "punct"


def span_features(text: str, a: int, b: int) -> list[str]:
    """Features of the whole segment text[a:b]; they do not decompose over atoms."""
    s = text[a:b]
    left, right = _side(text[a - 1:a]), _side(text[b:b + 1])
    d = _digits(s)
    if "@" in s or "at]" in s or "at)" in s:
        at = re.split(r"@|[\[(]at[\])]", s)
        host = re.sub(r"[\[(]dot[\])]", ".", at[-1]).split(".")
        ok = len(at) == 2 and bool(_LOCAL.match(at[0])) and len(host) > 1 and all(
            h and all(c.isalnum() or c == "-" for c in h) for h in host)
        return ["addr", f"addr:ok={ok}", f"addr:tld={host[-1].isalpha() and 1 < len(host[-1]) < 7}",
                f"addr:L={left}", f"addr:R={right}", f"addr:glued={left in ('alpha', 'digit', 'punct')}"]
    groups = re.findall(r"[0-9]+", s)
    n = len(d)
    bucket = "<7" if n < 7 else "7-9" if n < 10 else str(n) if n < 13 else "13-15" if n < 16 else "16" \
        if n == 16 else "17-19" if n < 20 else "20+"
    seps = "".join(sorted(set(s) - set("0123456789")))
    ip = len(groups) == 4 and seps == "." and all(map(_small, groups))
    even = len(set(map(len, groups[:-1]))) == 1 and len(groups) > 1
    return ["num", f"num:n={bucket}", f"num:plus={s[0] == '+'}", f"num:paren={'(' in s and ')' in s}",
            f"num:balanced={s.count('(') == s.count(')')}", f"num:ip={ip}",
            f"num:luhn={16 <= n <= 19 and luhn(d)}", f"num:n={bucket}&luhn={luhn(d)}",
            f"num:groups={min(len(groups), 6)}", f"num:seps={seps}", f"num:even={even}",
            f"num:L={left}", f"num:R={right}", f"num:tail={len(groups[-1])}",
            f"num:n={bucket}&paren={'(' in s}&plus={s[0] == '+'}"]


class SemiMarkov:
    """Weights by (kind, feature) and, for what stands right before, by (previous kind, kind) or
    ("", kind) after background; background scores 0."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.w = weights or {}

    def lattice(self, text: str, win: Window):
        """Atom offsets and the candidate segments ending at each atom."""
        cut = [win[0]] + [win[0] + m.end() for m in _ATOM.finditer(text[win[0]:win[1]])]
        ends: list[list[tuple[int, list[str]]]] = [[] for _ in cut]
        for j in range(1, len(cut)):
            last = text[cut[j - 1]]
            if not last.isalnum():
                continue
            for i in range(max(0, j - MAX_ATOMS), j):
                first = text[cut[i]]
                if not (first.isalnum() or first in "+("):
                    continue
                s = text[cut[i]:cut[j]]
                address = "@" in s or "at]" in s or "at)" in s
                if address and len(_AT.findall(s)) > 1:
                    continue  # no address holds two
                if address or (not any(c.isalpha() for c in s) and len(s) >= 7 and (
                        len(_digits(s)) >= 7 or s.count(".") == 3)):
                    ends[j].append((i, span_features(text, cut[i], cut[j])))
        return cut, ends

    def score(self, kind: str, feats: list[str], before: str) -> float:
        w = self.w
        return sum(w.get((kind, f), 0.0) for f in feats) + w.get((before, kind), 0.0)

    def decode(self, text: str, win: Window) -> list[Span]:
        """Viterbi over (atom, last kind): the best joint boundaries and kinds."""
        cut, ends = self.lattice(text, win)
        if not any(ends):
            return []
        best: list[dict[str, tuple[float, tuple | None]]] = [{"O": (0.0, None)}]
        for j in range(1, len(cut)):
            top = max(best[j - 1].items(), key=lambda x: x[1][0])
            cell = {"O": (top[1][0], (j - 1, top[0], None))}
            for i, feats in ends[j]:
                for k in KINDS:
                    own = sum(self.w.get((k, f), 0.0) for f in feats)
                    for p, (v, _) in best[i].items():
                        s = v + own + self.w.get(("" if p == "O" else p, k), 0.0)
                        if s > cell.get(k, (-math.inf, None))[0]:
                            cell[k] = (s, (i, p, k))
            best.append(cell)
        out, j = [], len(cut) - 1
        k = max(best[j].items(), key=lambda x: x[1][0])[0]
        while j > 0:
            i, p, kind = best[j][k][1]
            if kind:
                out.append((kind, cut[i], cut[j]))
            j, k = i, p
        return out[::-1]

    def gradient(self, text: str, win: Window, gold: set[Span]) -> tuple[float, dict]:
        """Log-likelihood of the gold segmentation and its gradient, by forward-backward over
        (atom, what stands right before it): background or an entity of some kind."""
        cut, ends = self.lattice(text, win)
        m, n = len(cut), len(KINDS)
        before = ("", *KINDS)
        step = np.array([[self.w.get((p, k), 0.0) for k in KINDS] for p in before])
        items = [(i, j, f, np.array([sum(self.w.get((k, x), 0.0) for x in f) for k in KINDS]))
                 for j in range(m) for i, f in ends[j]]
        by_end: list[list] = [[] for _ in cut]
        by_start: list[list] = [[] for _ in cut]
        for it in items:
            by_end[it[1]].append(it)
            by_start[it[0]].append(it)
        fwd, bwd = np.full((m, n + 1), -np.inf), np.full((m, n + 1), -np.inf)
        fwd[0, 0] = 0.0
        for j in range(1, m):
            fwd[j, 0] = np.logaddexp.reduce(fwd[j - 1])
            for i, _, _, s in by_end[j]:
                fwd[j, 1:] = np.logaddexp(fwd[j, 1:], s + np.logaddexp.reduce(fwd[i][:, None] + step, axis=0))
        bwd[m - 1] = 0.0
        for i in range(m - 2, -1, -1):
            bwd[i] = bwd[i + 1, 0]
            for _, j, _, s in by_start[i]:
                bwd[i] = np.logaddexp(bwd[i], np.logaddexp.reduce(step + s + bwd[j, 1:], axis=1))
        total = float(np.logaddexp.reduce(fwd[-1]))
        grad: dict[tuple[str, str], float] = {}

        def add(key: tuple[str, str], g: float) -> None:
            if abs(g) > 1e-6:
                grad[key] = grad.get(key, 0.0) + g

        ll, moves = -total, np.zeros((n + 1, n))
        ending = {b: KINDS.index(k) + 1 for k, _, b in gold}
        for i, j, f, s in items:
            odds = np.exp(np.minimum(0.0, fwd[i][:, None] + step + s + bwd[j, 1:] - total))
            moves -= odds
            for c, k in enumerate(KINDS):
                g = -float(odds[:, c].sum())
                if (k, cut[i], cut[j]) in gold:
                    prior = ending.get(cut[i], 0)
                    moves[prior, c] += 1.0
                    g, ll = g + 1.0, ll + float(s[c] + step[prior, c])
                if abs(g) > 1e-6:
                    for x in f:
                        add((k, x), g)
        for a, p in enumerate(before):
            for c, k in enumerate(KINDS):
                add((p, k), float(moves[a, c]))
        return ll, grad

    def fit(self, samples: list[tuple[str, Window, set[Span]]], epochs: int = 4, rate: float = 0.5,
            l2: float = 1e-3) -> "SemiMarkov":
        """AdaGrad on the conditional likelihood, in the given (fixed) order."""
        seen: dict[tuple[str, str], float] = {}
        for _ in range(epochs):
            for text, win, gold in samples:
                for key, g in self.gradient(text, win, gold)[1].items():
                    g -= l2 * self.w.get(key, 0.0)
                    seen[key] = seen.get(key, 1e-6) + g * g
                    self.w[key] = self.w.get(key, 0.0) + rate * g / math.sqrt(seen[key])
        return self


#: Context characters kept on either side of a training window, and its longest length.
CONTEXT, MAX_WINDOW = 12, 400


def _variants(text: str, span: Span) -> list[tuple[str, Span]]:
    """The window with its entity in another format, under the same label."""
    k, a, b = span
    s = text[a:b]
    if k == "phone":
        new = [re.sub(r"^\+[0-9]{1,3}[ .-]*", "", s)]
    elif k == "card":
        d = _digits(s)
        new = [".".join(d[i:i + 4] for i in range(0, len(d), 4)), "/".join(d[i:i + 4] for i in range(0, len(d), 4))]
    elif k == "email":
        new = [s.replace("@", "[at]"), s.replace("@", "(at)")]
    else:
        new = []
    return [(text[:a] + n + text[b:], (k, a, a + len(n))) for n in new if n and n != s]


def training_samples(chunks: list[str]) -> list[tuple[str, Window, set[Span]]]:
    out = []
    for t in chunks:
        gold = base_spans(t)
        clear = [g for g in gold if not any(h is not g and h[1] < g[2] and g[1] < h[2] for h in gold)]
        for w in windows(t):
            out.append((t, w, {g for g in clear if w[0] <= g[1] and g[2] <= w[1]}))
        if len(gold) == 1:
            for v, g in _variants(t, gold[0]):
                for w in windows(v):
                    if w[0] <= g[1] and g[2] <= w[1]:
                        out.append((v, w, {g}))
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_windows: int = 1500) -> SemiMarkov:
    """Fit on at most ``max_windows`` windows (each at most 400 characters with its
    context) with the smallest hashes, out of the distinct windows of all documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = {t[max(0, x - CONTEXT):y + CONTEXT] for t in b["text"] if t and _ANY.search(t)
                   for x, y in windows(t) if y - x <= MAX_WINDOW - 2 * CONTEXT}
            if got:
                yield pd.DataFrame({"chunk": sorted(got)})

    text_bytes_conf(docs.sparkSession)
    d = docs.select(F.col(f"`{text_col}`").alias("text")).where(F.col("text").rlike(r"[0-9@]"))
    top = (d.mapInPandas(run, "chunk string").select(F.xxhash64("chunk").alias("h"), "chunk")
           .groupBy("h", "chunk").agg(F.count(F.lit(1)).alias("n"))
           .orderBy("h", "chunk").limit(max_windows).collect())
    return SemiMarkov().fit(training_samples([r["chunk"] for r in top]))


def all_spans(text: str, base: list[Span], field: SemiMarkov) -> list[Span]:
    """Base spans plus the field's segments that overlap none of them."""
    added = [s for w in windows(text) for s in field.decode(text, w)
             if not any(s[1] < e and b < s[2] for _, b, e in base)]
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted({*base, *added}, key=lambda s: (order[s[0]], s[1], s[2]))


def find(docs: DataFrame, field: SemiMarkov | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per input row: id, base_spans and spans as arrays of
    (kind, start, end, text). Map-only."""
    field = field or train(docs, id_col, text_col)
    d = keyed(docs, "doc_id", doc_id=id_col, text=text_col)
    weights = Shared(docs.sparkSession, field.w)
    one = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"
    schema = f"doc_id string, base_spans {one}, spans {one}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = SemiMarkov(weights.value)
        for b in batches:
            base_col, span_col = [], []
            for t in b["text"]:
                base, spans = [], []
                if t and _ANY.search(t):
                    base = base_spans(t)
                    spans = all_spans(t, base, own)
                for col, found in ((base_col, base), (span_col, spans)):
                    col.append([{"kind": k, "start": x, "end": y, "value": t[x:y]} for k, x, y in found])
            yield pd.DataFrame({"doc_id": b["doc_id"], "base_spans": base_col, "spans": span_col})

    text_bytes_conf(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    return d.mapInPandas(run, schema).select(F.col("doc_id").cast(kind).alias(id_col), "base_spans", "spans")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns from ``find``."""

    def text_of(c: str):
        return F.array_join(F.transform(F.col(c), lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(k: str):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")

    return found.select(id_col, *map(count, KINDS), F.sha2(text_of("base_spans").cast("binary"), 256).alias("base_sha256"),
                        text_of("spans").alias("spans"))


def sha256_of(spans: list[Span]) -> str:
    return hashlib.sha256(render(spans).encode()).hexdigest()
