"""Personal data by candidate gradient boosting, in DataFrame functions throughout.

1. Base detectors find the four contract kinds. Patterns that nest repetition are rewritten over a marked copy of the text
   (a separator that joins two digits, or two domain characters, becomes one reserved character), so that each is a
   single character run: linear, without the stack that nested groups need on very long texts.
2. High-recall generators propose overlapping spans: number runs of any layout and, inside and across them, each window of consecutive
   digit groups whose digits fit a kind, as ip, card and phone, and addresses with ``@`` or a spelled ``at``. Spans are found by code point, from the lengths between matches.
3. Each candidate gets format and context features, as small whole numbers. Weak labels come from the base detectors: a
   candidate on a base span of its kind is positive; a number that meets one with other ends is neither used nor added; one on a span of another kind or one that breaks its
   kind's checks is negative,
   all others are unlabelled. Counts by feature pattern, a table whose size the features bound, go to the driver, where
   boosted trees are fitted; the trees come back as CASE expressions.
4. A quarter of the documents, by a hash of their id, is kept from the trees. Their labels calibrate the trees' scores per kind
   (isotonic), and set the kind's threshold: the lowest score with a calibrated probability of LEAST and the wanted precision above it.
   A kind with labels of one sort only among them adds nothing. The threshold selects the spans added to the base ones.

Nothing is shuffled but the pattern counts. Texts are read once: spans are stored before the model is fitted.

Defined results: null text is empty; null ``doc_id`` and repeated rows are treated row by row; without weak labels of both kinds
nothing is added; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import Boosted, Isotonic
from tidemark.llm.common import documents, staged, text_of

KINDS = ("email", "ip", "card", "phone")
FEATURES = ("kind", "digits", "seps", "groups", "luhn", "paren", "octets", "ctx", "edge")
PRECISION = 0.98
#: The least calibrated probability of an added candidate.
LEAST = 0.9
#: One in so many documents calibrates and does not teach.
ASIDE = 4
#: Feature patterns are products of small ranges; this bound is checked before they go to the driver.
PATTERNS = 50_000

_JOIN, _FREE = "\ue000", "\ue001"  # reserved, and what stands in for it where a text has it already
_LOCAL = rf"A-Za-z0-9._%+{_JOIN}-"
_EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++{_JOIN}[A-Za-z0-9{_JOIN}-]*+"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = rf"[0-9{_JOIN}]{{13,}}+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_NUMBER = r"[+(]{0,2}[0-9][0-9 ().,-]{5,40}[0-9]"
_REACH = 44  # characters of the longest run, and of the longest window of digit groups
_ADDRESS = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9.-]{1,64}(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]{1,32}){0,4}"
_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Words that announce a kind, in English, German, French and Spanish.
_ANNOUNCE = {
    "email": "mail|email|e-mail|contact|correo|courriel|kontakt",
    "ip": "ip|host|server|addr|address|adresse|servidor",
    "card": "card|visa|mastercard|amex|credit|karte|carte|tarjeta",
    "phone": "tel|phone|call|fax|mobile|telefon|anruf|appel|téléphone|teléfono|llame",
}
_SPAN = "array<struct<s:int,e:int,m:string>>"


def find_spans(work: Column, pattern: str) -> Column:
    """Array of (s, e, m): leftmost non-overlapping matches with their code points, end exclusive."""
    lengths = F.arrays_zip(F.transform(F.split(work, pattern, -1), F.length).alias("gap"), F.regexp_extract_all(work, F.lit(pattern), F.lit(0)).alias("m"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + x["gap"]
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        out = F.when(x["m"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(start.alias("s"), end.alias("e"), x["m"].alias("m")))))
        return F.struct(end.alias("pos"), out.alias("out"))

    return F.aggregate(lengths, F.struct(F.lit(0).alias("pos"), F.array().cast(_SPAN).alias("out")), step, lambda acc: acc["out"])


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    ds = F.transform(F.split(F.reverse(digits), "(?!^)(?=.)"), lambda d: d.cast("int"))
    doubled = F.transform(ds, lambda d, i: F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Per kind the array of base spans that pass the kind's check."""
    free = F.translate(text, _JOIN, _FREE)
    none = F.array().cast(_SPAN)
    dotted = F.regexp_replace(free, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _JOIN)
    joined = F.regexp_replace(free, r"(?<=[0-9])[\x20-](?=[0-9])", _JOIN)
    some_digit = text.rlike("[0-9]")

    def only(when: Column, spans: Column) -> Column:
        return F.when(when, spans).otherwise(none)

    count = lambda x: F.length(digits_of(x["m"]))
    return {
        "email": only(text.contains("@"), find_spans(dotted, _EMAIL)),
        "ip": only(some_digit, F.filter(find_spans(text, _IP), lambda x: x["m"].rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))),
        "card": only(some_digit, F.filter(F.filter(find_spans(joined, _CARD), lambda x: count(x).between(13, 19)), lambda x: luhn(digits_of(x["m"])))),
        "phone": only(text.contains("+"), F.filter(find_spans(text, _PHONE), lambda x: count(x).between(9, 15))),
    }


def _let(value: Column, use) -> Column:
    """``use(value)``, the value being computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _numbers(text: Column, run: Column) -> Column:
    """The run and the windows of consecutive digit groups (7 to 19 digits) that start in it, as (s, e, m, before, around).

    Windows may reach beyond the run's end. A group that a run's limit cut is whole here: its first part reads on, its second
    part starts no window. All is read off the text near the run, cut out once.
    """
    skip = F.greatest(run["s"] - 42, F.lit(0))
    near = F.struct(skip.alias("skip"), (run["s"] - skip).alias("s"), (run["e"] - skip).alias("e"), F.substring(text, skip + 1, run["e"] - skip + _REACH + 1).alias("t"))

    def span(x: Column, s: Column, e: Column) -> Column:
        around = F.concat(F.substring(x["t"], F.greatest(s, F.lit(1)), F.least(s, F.lit(1))), F.lit(" "), F.substring(x["t"], e + 1, F.lit(1)))
        before = F.substring(x["t"], F.greatest(s - 39, F.lit(1)), F.least(s, F.lit(40)))
        return F.struct((s + x["skip"]).alias("s"), (e + x["skip"]).alias("e"), F.substring(x["t"], s + 1, e - s).alias("m"), before.alias("before"), around.alias("around"))

    def windows(x: Column) -> Column:
        inside = F.regexp_extract(F.substring(x["t"], x["s"] + 1, F.lit(2 * _REACH + 1)), r"^[0-9 ().,+-]*", 0)
        cut = F.substring(x["t"], F.greatest(x["s"], F.lit(1)), F.least(x["s"], F.lit(1))).rlike("[0-9]")
        groups = F.filter(F.transform(find_spans(inside, "[0-9]+"), lambda g: F.struct((g["s"] + x["s"]).alias("s"), (g["e"] + x["s"]).alias("e"), F.length(g["m"]).alias("n"))), lambda g: ~(cut & (g["s"] == x["s"])))

        def starting(gs: Column, a: Column) -> Column:
            signs = F.length(F.regexp_extract(F.substring(x["t"], F.greatest(a["s"] - 1, F.lit(1)), F.least(a["s"], F.lit(2))), r"[+(]{0,2}$", 0))
            ends = F.filter(gs, lambda b: (b["s"] >= a["s"]) & (b["e"] - a["s"] <= _REACH) & (F.aggregate(gs, F.lit(0), lambda n, g: n + F.when((g["s"] >= a["s"]) & (g["s"] <= b["s"]), g["n"]).otherwise(0)).between(7, 19)))
            return _let(a["s"] - signs, lambda start: F.transform(ends, lambda b: span(x, start, b["e"])))

        return _let(groups, lambda gs: F.flatten(F.transform(F.filter(gs, lambda a: a["s"] < x["e"]), lambda a: starting(gs, a))))

    return _let(near, lambda x: F.array_distinct(F.concat(F.array(span(x, x["s"], x["e"])), windows(x))))


def candidates(text: Column) -> Column:
    """Array of proposed spans with what the features need: kind number, s, e and the features of FEATURES."""
    none = F.array().cast(_SPAN)
    numbers = F.col("numbers")
    addresses = F.transform(F.when(text.rlike(r"@|[\[(]at[\])]"), find_spans(text, _ADDRESS)).otherwise(none), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), F.substring(text, F.greatest(x["s"] - 39, F.lit(1)), F.least(x["s"], F.lit(40))).alias("before"), F.concat(F.substring(text, F.greatest(x["s"], F.lit(1)), F.least(x["s"], F.lit(1))), F.lit(" "), F.substring(text, x["e"] + 1, F.lit(1))).alias("around")))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")

    def proposal(x: Column, kind: int) -> Column:
        digits = digits_of(x["m"])
        groups = F.filter(F.split(x["m"], "[^0-9]+"), lambda g: g != "")
        before, around = F.lower(x["before"]), x["around"]
        n = F.length(digits)
        return F.struct(
            F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"),
            F.least(n, F.lit(20)).alias("digits"),
            F.least(F.length(F.regexp_replace(x["m"], r"[0-9A-Za-z]", "")), F.lit(8)).alias("seps"),
            F.least(F.size(groups), F.lit(6)).alias("groups"),
            flag(n.between(12, 19) & luhn(digits)).alias("luhn"),
            flag(x["m"].rlike(r"[()\[\]]")).alias("paren"),
            flag(x["m"].rlike(rf"^{_OCTET}(?:[.,]\x20?{_OCTET}){{3}}$")).alias("octets"),
            flag(before.rlike(rf"(?:^|[^a-z])(?:{_ANNOUNCE[KINDS[kind]]})[^0-9]{{0,20}}$")).alias("ctx"),
            flag(around.rlike(r"[A-Za-z0-9=_/]")).alias("edge"),
        )

    def fits(x: Column, kind: int) -> Column:
        n, parts = F.length(digits_of(x["m"])), F.size(F.split(x["m"], "[^0-9]+"))
        return (parts.between(4, 5) & (n <= 12)) if KINDS[kind] == "ip" else n.between(12, 19) if KINDS[kind] == "card" else n.between(7, 15)

    def proposals(k: int) -> Column:
        return F.transform(F.filter(numbers, lambda x: fits(x, k)), lambda x: proposal(x, k))

    return F.concat(F.transform(addresses, lambda x: proposal(x, 0)), *[proposals(k) for k in (1, 2, 3)])


def _covers(spans: Column, c: Column) -> Column:
    return F.exists(spans, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]))


def _span_rows(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    runs = F.when(text.rlike("[0-9]"), find_spans(text, _NUMBER)).otherwise(F.array().cast(_SPAN))
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("numbers", F.flatten(F.transform(runs, lambda r: _numbers(text, r))))
    rows = rows.select("doc_id", "text", *[v.alias(k) for k, v in base_spans(text).items()], candidates(text).alias("proposed"))
    slim = [F.transform(F.col(k), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(k) for k in KINDS]
    return rows.select("doc_id", "text", *slim, "proposed")


def span_table(docs: DataFrame) -> DataFrame:
    """Stored, a row per document: doc_id, base spans per kind, and all candidates with their features."""
    return staged(_span_rows(docs).drop("text"), "pii-spans")


def _agrees(spans: Column, c: Column) -> Column:
    """A base span with the candidate's ends, but for signs before the first digit; addresses need only meet."""
    return F.exists(spans, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]) & ((c["kind"] == 0) | ((b["e"] == c["e"]) & (F.abs(b["s"] - c["s"]) <= 2))))


def _met(c: Column) -> Column:
    """Whether the candidate meets a base span of its own kind."""
    met = F.lit(False)
    for k, name in enumerate(KINDS):
        met = met | ((c["kind"] == k) & _covers(F.col(name), c))
    return met


def _label(c: Column) -> Column:
    """1, 0 or null, from the base spans."""
    own, other = F.lit(False), F.lit(False)
    for k, name in enumerate(KINDS):
        own = own | ((c["kind"] == k) & _agrees(F.col(name), c))
        other = other | ((c["kind"] != k) & _covers(F.col(name), c))
    broken = F.when(c["kind"] == 1, c["octets"] == 0).when(c["kind"] == 2, (c["luhn"] == 0) | (c["digits"] < 13)).when(c["kind"] == 3, (c["digits"] < 9) | ((c["groups"] == 1) & (c["ctx"] == 0))).otherwise(F.lit(False))
    return F.when(own, 1).when(_met(c), F.lit(None).cast("int")).when(other | broken | (c["edge"] == 1), 0)


def _threshold(raw: np.ndarray, y: np.ndarray, n: np.ndarray) -> float:
    """The lowest score that is calibrated to LEAST and has the wanted precision at and above it; infinite without any."""
    if len(set(y.tolist())) < 2:
        return np.inf
    levels = np.unique(raw)[::-1]
    at = np.searchsorted(-levels, -raw)
    right, total = (np.cumsum(np.bincount(at, w, len(levels))) for w in (n * y, n))
    good = np.flatnonzero((right >= PRECISION * total) & (Isotonic(raw, y, n)(levels) >= LEAST))
    return float(levels[good[-1]]) if len(good) else np.inf


class SpanModel:
    """Trees over FEATURES and a log-odds threshold per kind."""

    def __init__(self, trees: Boosted | None, least: list[float]):
        self.trees, self.least = trees, least

    @classmethod
    def fit(cls, table: DataFrame) -> "SpanModel":
        aside = (F.pmod(F.xxhash64("doc_id"), F.lit(ASIDE)) == 0).alias("aside")
        labelled = table.select(aside, F.explode(F.transform("proposed", lambda c: F.struct(c.alias("c"), _label(c).alias("y")))).alias("r")).select("aside", "r.c.*", "r.y").filter("y IS NOT NULL")
        counted = labelled.groupBy(*FEATURES, "y", "aside").agg(F.count("*").alias("n"))
        got = counted.orderBy(F.desc("n"), *FEATURES, "y", "aside").limit(PATTERNS + 1).collect()
        if len(got) > PATTERNS:
            raise ValueError("more feature patterns than the features allow")
        x = np.array([[r[f] for f in FEATURES] for r in got], float).reshape(-1, len(FEATURES))
        y, n, held = np.array([r["y"] for r in got], float), np.array([r["n"] for r in got], float), np.array([r["aside"] for r in got], bool)
        if held.all() or len(set(y[~held].tolist())) < 2:
            return cls(None, [])
        trees = Boosted.fit(x[~held], y[~held], weight=n[~held], trees=30)
        raw = trees.raw(x)
        return cls(trees, [_threshold(raw[mine], y[mine], n[mine]) for mine in (held & (x[:, 0] == k) for k in range(len(KINDS)))])

    def log_odds(self, c: Column) -> Column:
        """The sum of the trees as an expression over a candidate."""

        def node(tree, k: int) -> Column:
            feature, cut, value = tree
            if k >= len(feature) or feature[k] < 0:
                return F.lit(float(value[k]))
            edges = self.trees.edges[feature[k]]
            left = c[FEATURES[feature[k]]] <= F.lit(float(edges[min(cut[k], len(edges) - 1)]))
            return F.when(left, node(tree, 2 * k + 1)).otherwise(node(tree, 2 * k + 2))

        total = F.lit(float(self.trees.base))
        for tree in self.trees.trees:
            total = total + node(tree, 0)
        return total

    def added(self) -> dict[str, Column]:
        """Per kind the array of selected spans that meet no base span."""
        if self.trees is None:
            return {k: F.array().cast("array<struct<s:int,e:int>>") for k in KINDS}
        scored = F.transform("proposed", lambda c: F.struct(c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e"), self.log_odds(c).alias("z"), (_label(c).isNull() & ~_met(c)).alias("free")))

        def chosen(k: int) -> Column:
            enough = F.lit(False) if np.isinf(self.least[k]) else None
            mine = F.filter(scored, lambda x: (x["kind"] == k) & x["free"] & (x["z"] >= F.lit(self.least[k]) if enough is None else enough))
            return F.transform(mine, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))

        return {name: chosen(k) for k, name in enumerate(KINDS)}


def _written(spans: dict[str, Column]) -> Column:
    def part(kind: str) -> Column:
        return F.transform(F.array_sort(spans[kind]), lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))

    return F.array_join(F.concat(*[part(k) for k in spans]), ",")


def _selected(table: DataFrame, model: SpanModel, *keep: str) -> DataFrame:
    extra = model.added()
    return table.select(*keep, *[F.col(k).alias(f"base_{k}") for k in KINDS], *[F.concat(F.col(k), extra[k]).alias(f"all_{k}") for k in KINDS])


def redactions(docs: DataFrame) -> DataFrame:
    """Per document: base and all spans of each kind as arrays (base_<kind>, all_<kind>)."""
    table = span_table(docs)
    return _selected(table, SpanModel.fit(table), "doc_id")


def redact(docs: DataFrame, mask: str = "*") -> DataFrame:
    """doc_id and the text with every selected code point replaced."""
    found = _selected(_span_rows(docs), SpanModel.fit(span_table(docs)), "doc_id", "text")
    hits = F.array_sort(F.concat(*[F.col(f"all_{k}") for k in KINDS]))

    def step(acc: Column, h: Column) -> Column:
        start, end = F.greatest(acc["pos"], h["s"]), F.greatest(acc["pos"], h["e"])
        out = F.concat(acc["out"], F.substring(F.col("text"), acc["pos"] + 1, start - acc["pos"]), F.repeat(F.lit(mask), end - start))
        return F.struct(end.alias("pos"), out.alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["pos"] + 1, F.length("text")))
    return found.select("doc_id", F.aggregate(hits, F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step, rest).alias("text"))


def op1_pii(spark, sf_dir: str) -> DataFrame:
    found = redactions(documents(spark, sf_dir))
    base = {k: F.col(f"base_{k}") for k in KINDS}
    every = {k: F.col(f"all_{k}") for k in KINDS}
    return found.select("doc_id", *[F.size(base[k]).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(_written(base), 256).alias("base_sha256"), _written(every).alias("spans"))
