"""Personal data by patterns and a semi-Markov conditional random field.

Base spans come from fixed patterns and always stay. The model adds what the patterns
are too strict for. It segments each zone - words that hold a digit or an @, joined by
single spaces - into atoms (runs of letters and digits, or one other character). A
segment is one atom outside any entity, or an entity of one kind and at most
`MAX_ATOMS` atoms. An entity is scored as a whole: how its digits are grouped, what it
opens and closes with, how many parts it has, whether check digits hold, and what
stands on either side. Dynamic programming over atoms and bounded entity lengths picks
boundaries and kinds together; training maximises the conditional likelihood of whole
segmentations with the forward-backward recursion over the same lattice.

Training takes the zones of all documents, folded by shape, and of those the
`TRAINING_SHAPES` most frequent (a documented bound) whose patterns all agree. Base
spans are the labels and what a check refused is none; runs of 20 and more digits that a
pattern took for one number, and overlapping base spans, stay out of training.

Defined results: a null text is empty; no spans give an empty string; positions are
code points, ends exclusive; null or repeated ids are rows like others; an empty table
gives no rows and a model that adds nothing.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

#: The kinds in their order and the base patterns.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Bounds of an entity.
MAX_ATOMS, MAX_CHARS = 24, 200
#: Zones longer than this are not used for training; they are decoded like others.
TRAINING_CHARS = 120
TRAINING_SHAPES = 600
ROUNDS = 60

_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_ATOM = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9]")
_DIGITS = re.compile(r"[0-9]")
_RUN = re.compile(r"[0-9]+")

Span = tuple[str, int, int]


# --- base patterns -------------------------------------------------------------------

def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(x), 10)) for x in even)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Found from the @ outwards, so that long runs without one cost nothing."""
    last = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            last = m.end()


def _ips(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in _DOTTED.finditer(text):
        parts = [(p.start() + m.start(), p.end() + m.start()) for p in _RUN.finditer(m.group())]
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            small = all(len(d := text[a:b].lstrip("0")) <= 3 and int(d or "0") <= 255 for a, b in four)
            yield four[0][0], four[3][1], small


def matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Every match of a base pattern and whether it passes its check."""
    if not _MARK.search(text):
        return
    if "@" in text:
        yield from (("email", a, b, True) for a, b in _emails(text))
    yield from (("ip", a, b, ok) for a, b, ok in _ips(text))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[\x20-]", "", m.group()) if len(m.group()) < 40 else ""
        yield "card", *m.span(), 14 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield "phone", *m.span(), 10 <= len(_DIGITS.findall(m.group())) <= 15


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# --- zones and segments --------------------------------------------------------------

def zones(text: str) -> list[tuple[int, int]]:
    """Words that hold a digit or an @, joined where one space parts them."""
    out, at = [], 0
    while mark := _MARK.search(text, at):
        start = 1 + max(at - 1, *(text.rfind(c, at, mark.start()) for c in " \t\n\v\f\r"))
        end = m.start() if (m := _SPACE.search(text, mark.end())) else len(text)
        if out and out[-1][1] + 1 == start and text[start - 1] == " ":
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
        at = end
    return out


def _edge(atom: str | None) -> str:
    if atom is None:
        return "end"
    return "digits" if atom.isdigit() else "word" if atom.isalnum() else "space" if atom == " " else "mark"


def _features(span: str, before: str | None, after: str | None) -> tuple[str, ...]:
    """What is true of a whole candidate entity."""
    runs = _RUN.findall(span)
    digits = "".join(runs)
    n = len(digits)
    size = "0" if not n else "1-6" if n < 7 else "7-9" if n < 10 else "10-13" if n < 14 else "14-19" if n < 20 else "20+"
    marks = "".join(sorted(set(_ATOM.sub(lambda m: "" if m.group().isalnum() else m.group(), span))))
    letters = any(c.isalpha() for c in span)
    out = [
        f"digits {size}", f"runs {min(len(runs), 6)}", f"marks {marks}", f"letters {letters}",
        f"opens {_edge(before)}", f"closes {_edge(after)}", f"first {span[0] if not span[0].isalnum() else _edge(span[0])}",
        f"at {min(span.count('@'), 2)}", f"digits {size} marks {marks} letters {letters}",
    ]
    if "@" in span:
        local, _, domain = span.rpartition("@")
        out.append(f"address {bool(local) and '@' not in local and '.' in domain and '..' not in domain}")
    if set(span) <= set("0123456789."):
        out.append(f"dotted {len(runs)} {all(len(r) <= 3 and int(r) <= 255 for r in runs)}")
    if 14 <= n <= 19 and not letters:
        out.append(f"check digit {luhn(digits)}")
    return tuple(out)


def lattice(zone: str) -> tuple[list[tuple[int, int]], list[tuple[int, int, tuple[str, ...]]]]:
    """Atoms of a zone, and its candidate entities as (first atom, last + 1, features).

    An entity opens with letters, digits, + or (, closes with letters or digits and holds
    a digit or an @; nothing else is a candidate.
    """
    atoms = [m.span() for m in _ATOM.finditer(zone)]
    of = [zone[a:b] for a, b in atoms]
    marked = [0]
    for x in of:
        marked.append(marked[-1] + bool(_MARK.search(x)))
    found = []
    for i, opening in enumerate(of):
        if not (opening[0].isalnum() or opening in "+("):
            continue
        for j in range(i + 1, min(i + MAX_ATOMS, len(of)) + 1):
            if atoms[j - 1][1] - atoms[i][0] > MAX_CHARS:
                break
            if of[j - 1][0].isalnum() and marked[j] > marked[i]:
                span = zone[atoms[i][0]:atoms[j - 1][1]]
                found.append((i, j, _features(span, of[i - 1] if i else None, of[j] if j < len(of) else None)))
    return atoms, found


# --- the model -----------------------------------------------------------------------

class Model:
    """Weights by (kind, feature); an atom outside entities scores 0."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = weights or {}

    def score(self, kind: str, features: tuple[str, ...]) -> float:
        return sum(self.weights.get((kind, f), 0.0) for f in features)

    def decode(self, zone: str) -> tuple[Span, ...]:
        """The best segmentation's entities, relative to the zone."""
        if not self.weights:
            return ()
        atoms, found = lattice(zone)
        best, back = [0.0] + [-math.inf] * len(atoms), [None] * (len(atoms) + 1)
        at = 0
        for i in range(len(atoms)):
            if best[i] > best[i + 1]:
                best[i + 1], back[i + 1] = best[i], None
            while at < len(found) and found[at][0] == i:
                _, j, features = found[at]
                for kind in KINDS:
                    total = best[i] + self.score(kind, features)
                    if total > best[j]:
                        best[j], back[j] = total, (kind, i)
                at += 1
        out, j = [], len(atoms)
        while j:
            if back[j] is None:
                j -= 1
            else:
                kind, i = back[j]
                out.append((kind, atoms[i][0], atoms[j - 1][1]))
                j = i
        return tuple(reversed(out))


def train(zone_labels: list[tuple[str, frozenset[Span], int]]) -> Model:
    """Weights that make the labelled segmentations likely; (zone, entities, how often)."""
    if not any(labels for _, labels, _ in zone_labels):
        return Model()
    cases = []
    for zone, labels, count in zone_labels:
        atoms, found = lattice(zone)
        truth = {(k, a, b) for k, a, b in labels}
        mine = [(i, j, f, k, (k, atoms[i][0], atoms[j - 1][1]) in truth) for i, j, f in found for k in KINDS]
        cases.append((len(atoms), mine, 1 + math.log(count)))
    weights: dict[tuple[str, str], float] = defaultdict(float)
    spread: dict[tuple[str, str], float] = defaultdict(lambda: 1e-6)
    for _ in range(ROUNDS):
        gradient: dict[tuple[str, str], float] = defaultdict(float)
        for n, mine, times in cases:
            scores = [sum(weights[k, f] for f in fs) for _, _, fs, k, _ in mine]
            into, out = defaultdict(list), defaultdict(list)
            for e, (i, j, *_) in enumerate(mine):
                into[j].append(e)
                out[i].append(e)
            ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
            for j in range(1, n + 1):
                ahead[j] = _logsum([ahead[j - 1], *(ahead[mine[e][0]] + scores[e] for e in into[j])])
            for i in range(n - 1, -1, -1):
                behind[i] = _logsum([behind[i + 1], *(behind[mine[e][1]] + scores[e] for e in out[i])])
            for e, (i, j, fs, k, true) in enumerate(mine):
                off = times * (true - math.exp(ahead[i] + scores[e] + behind[j] - ahead[n]))
                if abs(off) > 1e-6:
                    for f in fs:
                        gradient[k, f] += off
        for key, g in gradient.items():
            g -= 0.01 * weights[key]
            spread[key] += g * g
            weights[key] += 0.5 * g / math.sqrt(spread[key])
    return Model({k: round(w, 6) for k, w in weights.items() if w})


def _logsum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


# --- Spark ---------------------------------------------------------------------------

def _training_zones(text: str) -> Iterator[str]:
    """Zones fit for training, their labels in front: kind:start:end,...|zone, digits made alike.

    Digits keep what the features ask of them: check digits and parts up to 255.
    """
    found = list(matches(text))
    starts = sorted((a, b, k, ok) for k, a, b, ok in found)
    for a, b in zones(text):
        if b - a > TRAINING_CHARS:
            continue
        own = [(k, x - a, y - a, ok) for x, y, k, ok in starts[bisect_left(starts, (a,)):bisect_left(starts, (b,))]]
        good = [(k, x, y) for k, x, y, ok in own if ok]
        long = any(not ok and y - x >= 20 for _, x, y, ok in own)
        good.sort(key=lambda g: g[1:])
        if long or any(y > b - a for _, _, y in good) or any(s[2] > t[1] for s, t in zip(good, good[1:])):
            continue
        yield ",".join(f"{k}:{x}:{y}" for k, x, y in good) + "|" + text[a:b]


def _shape(labelled: str) -> str:
    """A zone's fold: digits and letters alike, its labels with it."""
    labels, _, zone = labelled.partition("|")
    return labels + "|" + re.sub(r"[0-9]", "9", re.sub(r"[A-Za-z]", "a", zone))


def fit(docs: DataFrame) -> Model:
    """A model from the zones of all texts; at most TRAINING_SHAPES short zones reach the driver."""

    @F.pandas_udf(T.ArrayType(T.StructType([
        T.StructField("shape", T.StringType()), T.StructField("zone", T.StringType()), T.StructField("n", T.LongType()),
    ])))
    def of(texts: pd.Series) -> pd.Series:
        """Each batch folds its zones; they come back with its first row."""
        counts, least = Counter(), {}
        for text in texts:
            if text:
                for zone in _training_zones(text):
                    shape = _shape(zone)
                    counts[shape] += 1
                    least[shape] = min(least.get(shape, zone), zone)
        out = pd.Series([[] for _ in range(len(texts))], dtype=object)
        if len(out):
            out.iloc[0] = [{"shape": s, "zone": least[s], "n": n} for s, n in counts.items()]
        return out

    rows = (
        docs.select(F.explode(of("text")).alias("z")).select("z.*").groupBy("shape")
        .agg(F.sum("n").alias("n"), F.min("zone").alias("zone"))
        .orderBy(F.desc("n"), "shape").limit(TRAINING_SHAPES).collect()
    )
    cases = []
    for r in rows:
        labels, _, zone = r["zone"].partition("|")
        spans = frozenset((k, int(a), int(b)) for k, a, b in (x.split(":") for x in labels.split(",") if x))
        cases.append((zone, spans, r["n"]))
    return train(cases)


def find(text: str, decode) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a text, in order."""
    base = [(k, a, b) for k, a, b, ok in matches(text) if ok]
    held = sorted((a, b) for _, a, b in base)
    more = []
    for start, end in zones(text):
        for kind, a, b in decode(text[start:end]):
            a, b = a + start, b + start
            at = bisect_left(held, (b,))
            if not any(y > a for _, y in held[max(0, at - 4):at]):
                more.append((kind, a, b))
    return _ordered(base), _ordered(base + more)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def spans_of(text: Column, model: Model) -> Column:
    """A struct of counts of base spans by kind, base spans and all spans (kind:start:end, comma-joined)."""
    kind = T.StructType(
        [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
        + [T.StructField("base", T.StringType()), T.StructField("spans", T.StringType())]
    )

    @F.pandas_udf(kind)
    def of(texts: pd.Series) -> pd.DataFrame:
        decode, rows = lru_cache(maxsize=20_000)(model.decode), []
        for text in texts:
            base, every = find(text or "", decode)
            n = Counter(k for k, _, _ in base)
            rows.append((*(n[k] for k in KINDS), _joined(base), _joined(every)))
        return pd.DataFrame(rows, columns=kind.names)

    return of(text)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans fall into one."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """The rows with personal data in `text` replaced by its kind, `n_chars` to match; null texts stay."""
    model = fit(docs)

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        decode = lru_cache(maxsize=20_000)(model.decode)
        return pd.Series([None if x is None else masked(x, find(x, decode)[1]) for x in texts], dtype=object)

    new = docs.withColumn("text", of("text"))
    if "n_chars" not in docs.columns:
        return new
    return new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def op10_find_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", spans_of(F.col("text"), fit(docs)).alias("s"))
    return found.select(
        "doc_id", *(f"s.n_{k}" for k in KINDS), F.sha2(F.col("s.base"), 256).alias("base_sha256"), "s.spans"
    )
