"""Personal data by candidate gradient boosting (operator 6).

One pass over the texts finds the base spans (fixed patterns and checks, always kept) and proposes further, overlapping
candidates with high recall: numbers inside runs that fail a base check, national phone numbers, spelled-out addresses, social
security numbers, account numbers and secrets. Each candidate carries features of its format and context. Boosted trees are
fitted on a bounded sample of documents: positives are their base spans and the same re-spelled in their places (spelled-out
addresses, national and grouped numbers), negatives the same with broken digits and the look-alikes that pass no check of
their kind. Thresholds come from all documents outside the sample: for each kind, candidates beyond the base are counted
by score and by an exact check (for secrets the name before them, which is no feature), and the least score is taken from
which the accepted ones reach the wanted precision. Accepted candidates that overlap nothing better are added.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

#: Fixed order of the base kinds, then of those that only the method adds.
KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "secret")

_EMAIL_END = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]|[\[(]at[\])]")
#: Generators of further candidates; all are linear in the text.
_MORE = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]{1,63}|\.[A-Za-z0-9-]{1,63}){1,4}")),
    ("phone", re.compile(r"(?<![A-Za-z0-9+])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,5}\)|[0-9]{2,5})[\x20.-]{1,2}[0-9]{2,5}[\x20.-][0-9]{3,5}(?![\x20.-]?[0-9])")),
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("card", re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([\x20.-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9])")),
    ("secret", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+=*+")),
)
#: Context words of each kind, looked for in the 40 characters before a candidate.
_CONTEXT = {
    "email": re.compile(r"mail|contact|write|@", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|addr", re.I),
    "card": re.compile(r"card|visa|credit|master|pay", re.I),
    "phone": re.compile(r"tel|phone|call|fax|mobile|cell", re.I),
    "ssn": re.compile(r"ssn|social|security", re.I),
    "iban": re.compile(r"iban|account|bank|konto", re.I),
    "secret": re.compile(r"[\"'=:]\s*$"),
}
#: The name before a secret: its label, never a feature.
_SECRET_NAME = re.compile(r"(?:token|secret|passw(?:or)?d|passphrase|credential|auth|bearer|key)s?[\"']?\s*(?:[:=]+|is)?\s*[\"']?$", re.I)
_DIGITS = re.compile(r"[0-9]+")
N_FEATURES = 19


@dataclass(frozen=True)
class PiiPolicy:
    """sample: bound on the documents that the trees are fitted on, the first with candidates in the order of a hash of their
    ids, each with document_rows training rows at most. precision: what the candidates over a threshold must reach, over all other
    documents; a kind with fewer than least_support true ones over any such score takes those that pass its exact check."""

    sample: int = 4_000
    document_rows: int = 32
    rounds: int = 40
    depth: int = 3
    rate: float = 0.2
    precision: float = 0.98
    least_support: int = 20


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @: a local part is the run of its characters before it. Linear in the text."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _EMAIL_END.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            yield start, last
        else:
            last = max(last, at + 1)
        at = text.find("@", max(at + 1, last))


def base_spans(text: str, failed: list | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans in order; matches that fail a check go to failed."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        good = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))
        (out if good else failed if failed is not None else []).append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
        elif failed is not None and 13 <= len(digits) <= 19:
            failed.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            n = sum(map(len, _DIGITS.findall(m.group())))
            if 10 <= n <= 15:
                out.append((m.start(), 3, m.end()))
            elif failed is not None and 8 <= n <= 17:
                failed.append((m.start(), 3, m.end()))
    return sorted(out)


def _national(digits: str) -> bool:
    return len(digits) == 10 and digits[0] in "23456789" and digits[3] in "23456789"


def _checked(kind: str, s: str) -> bool:
    """Exact check of a kind's form, where it has one."""
    digits = "".join(_DIGITS.findall(s))
    if kind == "email":
        return bool(re.search(r"(?:\.|dot[\])] ?)[A-Za-z]{2,}$", s))
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15 if s[0] == "+" else _national(digits)
    if kind == "ssn":
        return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"
    if kind == "iban":
        flat = s.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1
    return 3 <= len(digits) <= len(s) - 3


def _label(text: str, start: int, kind: int, end: int) -> bool:
    """Whether a candidate beyond the base counts as true in calibration: its exact check; for a secret the name before it."""
    if KINDS[kind] == "secret":
        return bool(_SECRET_NAME.search(text, max(0, start - 40), start))
    return _checked(KINDS[kind], text[start:end])


def candidates_of(text: str, base: list[tuple[int, int, int]], failed: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further candidates of a text: failed base matches and what the generators propose; none is a base span."""
    found = set(failed)
    for kind, pattern in _MORE:
        k = KINDS.index(kind)
        for m in pattern.finditer(text):
            if kind != "secret" or _checked("secret", m.group()):
                found.add((m.start(), k, m.end()))
    return sorted(found.difference(base))


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 3 if c.isdigit() else 2 if c.isalpha() else 1


def _features(text: str, start: int, kind: int, end: int) -> list[int]:
    s = text[start:end]
    groups = _DIGITS.findall(s) or [""]
    digits = "".join(groups)
    sizes = list(map(len, groups))
    return [
        kind,
        min(end - start, 255),
        min(len(digits), 255),
        min(sum(map(str.isalpha, s)), 255),
        min(len(groups), 255),
        min(max(sizes), 255),
        min(min(sizes), 255),
        min(max(int(g[:6] or 0) for g in groups) // 4, 255),
        min(s.count(" "), 255),
        min(s.count("-"), 255),
        min(s.count("."), 255),
        s[0] == "+",
        "(" in s,
        int(digits[:1] or 0),
        len(set(digits)),
        _side(text[start - 1 : start]) if start else 0,
        _side(text[end : end + 1]),
        bool(_CONTEXT[KINDS[kind]].search(text, max(0, start - 40), start)),
        _checked(KINDS[kind], s),
    ]


def _respelled(s: str, kind: int, turn: int) -> list[tuple[str, bool]]:
    """A base span written otherwise, and broken: (text, still true)."""
    if KINDS[kind] == "email":
        at = (" [at] ", "(at)", " (at) ")[turn % 3]
        name, _, host = s.partition("@")
        return [(f"{name}{at}{host}", True), (f"{name}{at}{host.replace('.', ' [dot] ')}", True), (f"{name[:8]} (at) {turn}.{turn % 7}", False)]
    digits = "".join(_DIGITS.findall(s))
    if KINDS[kind] == "card":
        mark = " -."[turn % 3]
        parts = mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + turn % 8) % 10)
        return [(f"{digits} {wrong}", True), (parts, True), (f"{wrong} {wrong}", False), (mark.join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), False)]
    if KINDS[kind] == "phone":
        mark = " .-"[turn % 3]
        area = str(2 + turn % 8) + digits[-9:-7]
        line = mark.join([str(2 + turn % 7) + digits[-6:-4], digits[-4:]])
        return [(f"({area}) {line}", True), (f"{area}{mark}{line}", True), (f"0{area[1:]}{mark}1{line[1:]}", False), (f"20{turn % 30:02d}{mark}{turn % 12 + 10}{mark}1999", False)]
    if KINDS[kind] == "ip":
        return [(s.rpartition(".")[0] + f".{256 + turn % 700}", False), (f"{turn % 20}.{turn % 13}.{turn}.{turn % 9000 + 300}", False)]
    return []


def training_rows(text: str, policy: PiiPolicy = PiiPolicy()) -> list[tuple[list[int], bool]]:
    """(features, label) of a text's base spans, of the same re-spelled or broken in their places, and of its other candidates."""
    failed: list = []
    base = base_spans(text, failed)
    rows = [(_features(text, *s), True) for s in base] + [(_features(text, *s), _label(text, *s)) for s in candidates_of(text, base, failed)]
    for turn, (start, kind, end) in enumerate(base[: policy.document_rows]):
        for written, good in _respelled(text[start:end], kind, start + turn):
            around = text[max(0, start - 40) : start] + written + text[end : end + 2]
            a, b = min(start, 40), min(start, 40) + len(written)
            lost: list = []
            known = base_spans(around, lost)
            inside = [c for c in candidates_of(around, known, lost) if c[1] == kind and a <= c[0] and c[2] <= b]
            rows += [(_features(around, *c), good and _label(around, *c)) for c in inside]
    return rows[:: max(1, -(-len(rows) // policy.document_rows))]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small batches: the texts of a large one, as Python strings, take many times its room."""
    for batch in batches:
        for i in range(0, len(batch), rows):
            yield batch.slice(i, rows)


def find_candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base (flat start, kind, end), cand (flat start, kind, end), feat (bytes, N_FEATURES a candidate), label (bytes) for every row.

    cand: candidates beyond the base. Null texts count as empty. Other columns are not looked at, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            base, cand, feat, label = [], [], [], []
            for text in batch.column(1).to_pylist():
                found, spans = [], []
                if text and _ANY.search(text):
                    spans = base_spans(text, found)
                    found = candidates_of(text, spans, found)
                base.append([x for s in spans for x in s])
                cand.append([x for s in found for x in s])
                feat.append(bytes(int(x) for s in found for x in _features(text, *s)))
                label.append(bytes(_label(text, *s) for s in found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.list_(pa.int32())), pa.array(cand, pa.list_(pa.int32())), pa.array(feat, pa.binary()), pa.array(label, pa.binary())],
                ["doc_id", "base", "cand", "feat", "label"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, base array<int>, cand array<int>, feat binary, label binary")


@dataclass
class Boosted:
    """trees: (feature, cut, value) arrays of complete trees. thresholds: least score that is accepted, for each kind. checked: kinds that go by their exact check."""

    base: float
    trees: list
    depth: int
    thresholds: np.ndarray
    checked: np.ndarray = field(default_factory=lambda: np.ones(len(KINDS), bool))

    def accepts(self, x: np.ndarray) -> np.ndarray:
        """Score of each candidate, or -1 where it is not accepted. The last feature is the exact check."""
        score = self.score(x)
        kind = x[:, 0].astype(np.int64)
        return np.where(np.where(self.checked[kind], x[:, -1] > 0, score >= self.thresholds[kind]), score, -1.0)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            out += value[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-out))


def fit_trees(x: np.ndarray, y: np.ndarray, policy: PiiPolicy) -> Boosted:
    """Logistic boosting with complete trees over byte features; no threshold yet. Rows of one label only, or too few: no trees."""
    none = Boosted(0.0, [], policy.depth, np.full(len(KINDS), 2.0))
    if len(x) < policy.least_support or y.all() or not y.any():
        return none
    ty = y.astype(float)
    p = np.clip(ty.mean(), 1e-3, 1 - 1e-3)
    base, n_inner = float(np.log(p / (1 - p))), 2**policy.depth - 1
    margin, trees = np.full(len(x), base), []
    for _ in range(policy.rounds):
        prob = 1 / (1 + np.exp(-margin))
        grad, hess = ty - prob, prob * (1 - prob)
        feature, cut, node = np.zeros(n_inner, np.int64), np.full(n_inner, 255), np.zeros(len(x), np.int64)
        for level in range(policy.depth):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                at = node == k
                best = 1e-6
                for f in range(x.shape[1]):
                    g = np.cumsum(np.bincount(x[at, f], grad[at], 256))
                    h = np.cumsum(np.bincount(x[at, f], hess[at], 256))
                    gain = g**2 / (h + 1) + (g[-1] - g) ** 2 / (h[-1] - h + 1) - g[-1] ** 2 / (h[-1] + 1)
                    if gain.max() > best:
                        best, feature[k], cut[k] = gain.max(), f, int(gain.argmax())
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
        leaf = node - n_inner
        value = policy.rate * np.bincount(leaf, grad, n_inner + 1) / (np.bincount(leaf, hess, n_inner + 1) + 1)
        margin += value[leaf]
        trees.append((feature, cut, value))
    return Boosted(base, trees, policy.depth, none.thresholds)


_BINS = 200


def score_counts(candidates: DataFrame, model: Boosted, beyond: int | None) -> DataFrame:
    """(kind, bin, n, good): candidates of the documents whose draw is greater than beyond, by score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, good = np.zeros((len(KINDS), _BINS + 1), np.int64), np.zeros((len(KINDS), _BINS + 1), np.int64)
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, N_FEATURES)
            y = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8)
            at = x[:, 0].astype(np.int64), np.floor(model.score(x) * _BINS).astype(np.int64)
            np.add.at(n, at, 1)
            np.add.at(good, at, y)
        k, b = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(b), pa.array(n[k, b]), pa.array(good[k, b])], ["kind", "bin", "n", "good"])

    rows = candidates.where(F.length("label") > 0)
    if beyond is not None:
        rows = rows.where(_draw() > beyond)
    return rows.select("feat", "label").mapInArrow(run, "kind long, bin long, n long, good long").groupBy("kind", "bin").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))


def calibrate(model: Boosted, counts: list, policy: PiiPolicy) -> Boosted:
    """Sets each kind's least score: the lowest from which on the wanted share of the candidates is true. checked: kinds without such a score (too few true candidates, or none that reaches it), which go by their exact check."""
    n, good = np.zeros((len(KINDS), _BINS + 1)), np.zeros((len(KINDS), _BINS + 1))
    for r in counts:
        n[r.kind, r.bin], good[r.kind, r.bin] = r.n, r.good
    over, true = n[:, ::-1].cumsum(axis=1)[:, ::-1], good[:, ::-1].cumsum(axis=1)[:, ::-1]
    for k in range(len(KINDS)):
        enough = (true[k] >= policy.precision * over[k]) & (true[k] >= policy.least_support)
        model.thresholds[k] = np.flatnonzero(enough)[0] / _BINS if enough.any() else 2.0
    model.checked = model.thresholds > 1
    return model


def _draw():
    return F.xxhash64(F.col("doc_id").cast("string"))


def fit_pii_model(docs: DataFrame, candidates: DataFrame, policy: PiiPolicy = PiiPolicy()) -> Boosted:
    """Trees from policy.sample documents, thresholds from the candidates of all others (of all, if there are no more)."""
    drawn = candidates.where("size(base) > 0 OR size(cand) > 0").select("doc_id", _draw().alias("draw")).where("doc_id IS NOT NULL")
    sample = stage(drawn.orderBy("draw", "doc_id").limit(policy.sample), "sample")
    ids = sample.select("doc_id").distinct()
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi").select("text")  # sample ids at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            made = [training_rows(t, policy) for t in batch.column(0).to_pylist() if t]
            feat = [bytes(map(int, f)) for r in made for f, _ in r]
            yield pa.RecordBatch.from_arrays([pa.array(feat, pa.binary()), pa.array([y for r in made for _, y in r], pa.bool_())], ["feat", "y"])

    got = rows.mapInArrow(run, "feat binary, y boolean").orderBy("feat", "y").limit(policy.sample * policy.document_rows).toArrow()
    x = np.frombuffer(b"".join(got["feat"].to_pylist()), np.uint8).reshape(-1, N_FEATURES)
    model = fit_trees(x, got["y"].to_numpy().astype(bool), policy)
    last, many = sample.agg(F.max("draw"), F.count("*")).first()
    return calibrate(model, score_counts(candidates, model, last if many >= policy.sample else None).collect(), policy)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def added_spans(base: list[tuple[int, int, int]], cand: list[tuple[int, int, int]], score: np.ndarray) -> list[tuple[int, int, int]]:
    """Base spans and, best first, the accepted candidates (score 0 or more) that overlap nothing taken before; in order."""
    chosen, starts, ends = list(base), [], []
    for s, _, e in sorted(base):  # the union of the base spans
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s), ends.append(e)
    for j in np.argsort(-score, kind="stable").tolist():
        if score[j] < 0:
            break
        s, k, e = cand[j]
        at = bisect_left(ends, s + 1)  # the first taken span that ends behind s
        if at == len(ends) or e <= starts[at]:
            chosen.append((s, k, e))
            starts.insert(at, s), ends.insert(at, e)
    return sorted(chosen)


def _triples(flat) -> list[tuple[int, int, int]]:
    return [tuple(map(int, flat[i : i + 3])) for i in range(0, len(flat), 3)]


def select_spans(candidates: DataFrame, model: Boosted) -> DataFrame:
    """For each row of find_candidates(): doc_id, counts and digest of the base spans, spans (all), n_added, spans_flat (start, kind, end)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            sizes = pdf["cand"].map(len).to_numpy(dtype=np.int64) // 3
            score = model.accepts(np.frombuffer(b"".join(map(bytes, pdf["feat"])), np.uint8).reshape(-1, N_FEATURES))
            ends, rows = np.cumsum(sizes), []
            for base, cand, stop, n in zip(pdf["base"], pdf["cand"], ends, sizes, strict=True):
                base = _triples(base)
                chosen = added_spans(base, _triples(cand), score[stop - n : stop])
                kinds = [k for _, k, _ in base]
                rows.append(
                    [*(kinds.count(k) for k in range(4)), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(chosen), len(chosen) - len(base), [v for c in chosen for v in c]]
                )
            out = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "spans_flat"])
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    kind = candidates.schema["doc_id"].dataType.simpleString()
    return candidates.mapInPandas(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, spans_flat array<int>")


def detect_pii(docs: DataFrame, policy: PiiPolicy = PiiPolicy()) -> DataFrame:
    """Base and added spans of every document; a row for each row of docs, also where texts are null, empty or repeated.

    Rows that repeat an id are texts of their own; a null id is allowed. Needs doc_id and text; other columns are not looked at.
    """
    candidates = stage(find_candidates(docs), "pii")
    return select_spans(candidates, fit_pii_model(docs, candidates, policy))


def redact(text: str, flat: list[int]) -> str:
    """text with each span replaced by its kind in brackets; spans inside or across an earlier one are covered by it."""
    out, at = [], 0
    for i in range(0, len(flat), 3):
        s, k, e = flat[i : i + 3]
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        elif e > at:
            out.append(f"[{KINDS[k].upper()}]")
        at = max(at, e)
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame, policy: PiiPolicy = PiiPolicy()) -> DataFrame:
    """docs with the spans of their texts replaced; other columns as they are, null texts stay null. The trees come from one pass, the texts change in another."""
    model = fit_pii_model(docs, stage(find_candidates(docs), "pii"), policy)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = [t if not t or not _ANY.search(t) else redact(t, spans_of(t, model)) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def spans_of(text: str, model: Boosted) -> list[int]:
    """Flat (start, kind, end) of all spans of one text."""
    failed: list = []
    base = base_spans(text, failed)
    found = candidates_of(text, base, failed)
    if not found:
        return [v for c in base for v in c]
    score = model.accepts(np.array([_features(text, *s) for s in found], np.uint8).reshape(-1, N_FEATURES))
    return [v for c in added_spans(base, found, score) for v in c]
