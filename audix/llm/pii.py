"""Personal data by weak supervision (operator 5).

Each kind (email, ip, card, phone) has a strict pattern and a loose one for
written-around forms. Every match is a candidate span. Labelers vote on
candidates: the strict pattern with its check, a gazetteer (top domains, address ranges, issuer
prefixes, area codes), words in the context, the shape and the neighbouring characters; each
says yes (1), no (0) or abstains (-1). Expectation-maximisation over the counts of vote patterns
estimates, for every kind, the share of true spans and each labeler's behaviour on true and false
ones. The posteriors then train a logistic span classifier on the votes and the length, which decides
about the loose candidates. Strict matches that pass their check always stay.

DataFrame functions only. The driver sees counts of vote patterns, of which there are at most
``kinds * 2 * 3**4 * lengths``. Deciding is a row-wise expression; spans are placed
by sums over the gaps between matches. Patterns use possessive repeats and look-behinds that keep
them linear on long runs.

Defined cases: a null text counts as an empty one and has no spans; null and repeated ids and rows are judged
one by one; an empty table trains on nothing and gives no rows; other columns are not read
(:func:`redact` keeps them, and leaves a null text null).
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audix.llm.common import quoted, staged

#: Characters before and after a match that labelers see.
CONTEXT = 24
ROUNDS = 50
#: Longest text in code points, for telling kinds apart by place; characters of a text that are cut at a time.
AXIS, CHUNK = 1 << 40, 64
LABELERS = ("strict", "gazetteer", "context", "shape", "edges")

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_DIGITS = r"[^0-9]"


@dataclass(frozen=True)
class Kind:
    name: str
    strict: str
    loose: str
    gazetteer: str  # searched in the match (of digits only if by_digits)
    by_digits: bool
    yes: str  # words before a true span
    no: str  # words before a false one


KINDS = (
    Kind("email",
         r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\[at\]|\(at\)|<at>)\x20?[A-Za-z0-9-]++"
         r"(?:\x20?(?:\.|\[dot\]|\(dot\)|<dot>)\x20?[A-Za-z0-9-]++)++",
         r"(?i)(?:com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|us|ch|at|nl)$", False,
         r"(?i)e-?mail|contact|write|mailto|reach", r"(?i)version|commit|password|token|key"),
    Kind("ip",
         r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
         r"^(?!0+\.|127\.|255\.)", False,
         r"(?i)\bip\b|address|host|server|client|from", r"(?i)version|release|section|chapter"),
    Kind("card",
         r"[0-9](?:[\x20-]?[0-9])++",
         r"(?<![0-9])[0-9]{4}(?:[./_][0-9]{4}){2}[./_][0-9]{1,7}(?![0-9])",
         r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))", True,
         r"(?i)card|visa|credit|debit|account|pay", r"(?i)isbn|order|serial|invoice|tracking|token"),
    Kind("phone",
         r"\+[0-9][\x20().0-9-]+[0-9]",
         r"(?<![0-9+-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
         r"^(?:1?[2-9][0-9]{2}[2-9]|[2-9][0-9])", True,
         r"(?i)tel|phone|call|mobile|fax|cell", r"(?i)isbn|order|serial|version|score|page"),
)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, _DIGITS, "")


def passes(kind: str, match: Column) -> Column:
    """The check of a strict match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    n = F.length(_digits(match))
    if kind == "card":
        return n.between(13, 19) & F.call_function("luhn_check", _digits(match))
    return n.between(9, 15)


def _ask(said_yes: Column, said_no: Column) -> Column:
    return F.when(said_yes, 1).when(said_no, 0).otherwise(-1)


def votes(kind: Kind, strict: bool, match: Column, before: Column, after: Column) -> dict[str, Column]:
    """What each labeler says of a candidate."""
    body = _digits(match) if kind.by_digits else match
    known = body.rlike(kind.gazetteer)
    dull = body.rlike(r"^(.)\1*$")
    glued = before.rlike(r"[\p{L}\p{N}@_]$") | after.rlike(r"^[\p{L}\p{N}@_]")
    return {
        "strict": F.when(passes(kind.name, match), 1).otherwise(0) if strict else F.lit(-1),
        "gazetteer": _ask(known, ~known),
        "context": _ask(before.rlike(kind.yes), before.rlike(kind.no)),
        "shape": _ask(F.lit(False), dull),
        "edges": _ask(~glued, glued),
        "size": F.least(F.length(match) / 8, F.lit(4)).cast("int"),
    }


def _judged(kind: int, loose: bool, m: Column, i: Column, gaps: Column) -> Column:
    """The candidate of match ``m``, number ``i`` of its pattern, as a struct."""
    gap = F.get(gaps, i)
    said = votes(KINDS[kind], not loose, m, F.right(gap, F.lit(CONTEXT)), F.left(F.get(gaps, i + 1), F.lit(CONTEXT)))
    return F.struct(F.lit(kind).alias("kind"), F.lit(loose).alias("loose"), i.alias("at"), F.length(gap).alias("gap"),
                    F.length(m).alias("n"), *(v.cast("int").alias(x) for x, v in said.items()))


def _patterns() -> list[tuple[int, bool, str]]:
    return [(i, loose, k.loose if loose else k.strict) for i, k in enumerate(KINDS) for loose in (False, True)]


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` and ``_found``: all matches with the length of the gap before them and their votes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = docs.select("*", *(c for i, (_, _, pattern) in enumerate(_patterns()) for c in (
        F.split(text, pattern, -1).alias(f"_gaps{i}"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias(f"_hits{i}"))))

    def judged(i: int, kind: int, loose: bool) -> Column:
        return F.transform(f"_hits{i}", lambda m, at: _judged(kind, loose, m, at, F.col(f"_gaps{i}")))

    lists = [judged(i, kind, loose) for i, (kind, loose, _) in enumerate(_patterns())]
    return cut.select(*docs.columns, F.concat(*lists).alias("_found"))


@dataclass
class Classifier:
    """Logistic weights by (kind, feature, value), and what EM found (kind: prior, labeler behaviour)."""
    weights: dict[tuple, float]
    reliability: dict[int, dict]

    def chance(self, span: Column) -> Column:
        """Probability that a candidate is personal data."""
        by_feature = defaultdict(list)
        for (kind, feature, value), w in sorted(self.weights.items(), key=str):
            by_feature[feature].append((kind, value, w))
        total = F.lit(0.0)
        for feature, known in by_feature.items():
            if feature == "bias":
                key, table = span["kind"], [(k, w) for k, _, w in known]
            else:
                key, table = span["kind"] * 100 + span[feature], [(k * 100 + v, w) for k, v, w in known]
            step = F.lit(0.0)
            for at, w in table:
                step = F.when(key == at, F.lit(float(w))).otherwise(step)
            total = total + step
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


_FEATURES = ("gazetteer", "context", "shape", "edges", "size")


def _em(patterns: dict[tuple, int]) -> tuple[dict[tuple, float], dict[int, dict]]:
    """Posterior of each pattern (kind, votes of LABELERS, size), and the reliabilities."""
    posterior, found = {}, {}
    for kind in {p[0] for p in patterns}:
        own = {p: n for p, n in patterns.items() if p[0] == kind}
        q = {p: (1 + sum(v == 1 for v in p[1:6]) * 2) / (2 + 2 * sum(v >= 0 for v in p[1:6])) for p in own}
        prior, says = 0.5, {}
        for _ in range(ROUNDS):
            true = sum(n * q[p] for p, n in own.items())
            total = sum(own.values())
            prior = (true + 1) / (total + 2)
            for j, labeler in enumerate(LABELERS, 1):
                for y in (0, 1):
                    mass = true if y else total - true
                    for v in (-1, 0, 1):
                        part = sum(n * (q[p] if y else 1 - q[p]) for p, n in own.items() if p[j] == v)
                        # A labeler is taken to be better than chance until shown otherwise.
                        says[labeler, y, v] = (part + (2 if v == y else 1)) / (mass + 4)
            for p in own:
                up = math.log(prior) + sum(math.log(says[x, 1, p[j]]) for j, x in enumerate(LABELERS, 1))
                down = math.log(1 - prior) + sum(math.log(says[x, 0, p[j]]) for j, x in enumerate(LABELERS, 1))
                q[p] = 1 / (1 + math.exp(max(-500.0, min(500.0, down - up))))
        posterior |= q
        found[kind] = {"prior": prior, "says": says}
    return posterior, found


def train(counts: dict[tuple, int]) -> Classifier:
    """The span classifier from counts of (kind, votes of LABELERS, size)."""
    posterior, found = _em(counts)
    rows = [([(p[0], "bias", 0)] + [(p[0], f, p[2 + i]) for i, f in enumerate(_FEATURES)], posterior[p], n)
            for p, n in counts.items()]
    total = sum(n for *_, n in rows) or 1
    weights: dict[tuple, float] = defaultdict(float)
    for _ in range(300):
        slope: dict[tuple, float] = defaultdict(float)
        for keys, y, n in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[k] for k in keys)))))
            for k in keys:
                slope[k] += n * (y - p)
        mass: dict[tuple, float] = defaultdict(float)
        for keys, _, n in rows:
            for k in keys:
                mass[k] += n
        for k, g in slope.items():
            weights[k] += (g - 0.01 * weights[k]) / (0.25 * len(_FEATURES) * mass[k] + 1)
    return Classifier(dict(weights) if total else {}, found)


def fit(found: DataFrame) -> Classifier:
    """Train on every candidate of a table with ``_found``."""
    keys = ("kind", *LABELERS, "size")
    counted = (found.select(F.explode("_found").alias("c")).select(*(f"c.{k}" for k in keys))
               .groupBy(*keys).count().collect())
    return train({tuple(r[k] for k in keys): r["count"] for r in counted})


def kept(span: Column, model: Classifier) -> Column:
    """Whether a candidate counts as personal data."""
    return (span["strict"] == 1) | (span["loose"] & (model.chance(span) >= 0.5))


def find(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """A row for each row of ``docs``: doc_id and ``spans``, an array of (kind, start, end, base).

    Kinds are numbers in the order of ``KINDS``; offsets are code points. ``base`` marks strict
    matches; a loose span that overlaps a strict one of its kind is left out.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"),
                       F.monotonically_increasing_id().alias("_row"))
    rows = staged(docs.sparkSession, candidates(rows, "_text").select("_row", "doc_id", "_found"), "pii-candidates")
    model = fit(rows)
    each = rows.select("_row", "doc_id", F.explode_outer("_found").alias("c")).repartition("_row")
    placed = each.withColumn("_end", F.sum(F.col("c.gap").cast("long") + F.col("c.n")).over(
        Window.partitionBy("_row", "c.kind", "c.loose").orderBy("c.at")))
    placed = placed.withColumn("_start", F.col("_end") - F.col("c.n"))
    base = F.col("c.strict") == 1
    by_place = Window.partitionBy("_row", "c.kind").orderBy("_start", "_end")
    taken = F.coalesce(
        (F.max(F.when(base, F.col("_end"))).over(by_place.rowsBetween(Window.unboundedPreceding, -1)) > F.col("_start")),
        F.lit(False)) | F.coalesce(
        (F.min(F.when(base, F.col("_start"))).over(by_place.rowsBetween(1, Window.unboundedFollowing)) < F.col("_end")),
        F.lit(False))
    span = F.struct(F.col("c.kind").alias("kind"), F.col("_start").alias("start"), F.col("_end").alias("end"),
                    base.alias("base"))
    placed = placed.withColumn("_span", F.when(kept(F.col("c"), model) & (base | ~taken), span))
    return (placed.groupBy("_row").agg(F.first("doc_id").alias("doc_id"),
                                       F.sort_array(F.collect_list("_span")).alias("spans")).drop("_row"))


def _running(values: Column, step) -> Column:
    """``step`` (associative, skips nulls) over every prefix of an array, in rounds over doubled distances."""
    far = F.filter(F.array(*(F.lit(1 << i) for i in range(31))), lambda d: d < F.size(values))
    return F.aggregate(far, values, lambda a, d: F.transform(a, lambda x, i: F.when(i >= d, step(F.get(a, i - d), x)).otherwise(x)))


def _add(a: Column, b: Column) -> Column:
    return a + b


def _piece(start: Column, end: Column) -> Column:
    """The characters [start, end) of the text in ``_chunks``."""
    first = F.floor(start / CHUNK).cast("int")
    count = F.floor((end - 1) / CHUNK).cast("int") - first + 1
    cut = F.substring(F.array_join(F.slice("_chunks", first + 1, count), ""),
                      (start - first * CHUNK + 1).cast("int"), (end - start).cast("int"))
    return F.when(end > start, cut).otherwise("")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced by the kind in brackets, such as ``[EMAIL]``.

    The spans are those of :func:`find`, all judged on the input. Overlapping ones, of whatever kinds, are
    cut out as one, which takes the kind of the first of them (of several that begin there, of the longest).
    A cut can lay open a strict span where a longer match had failed its check; such spans then go kind by kind.
    """
    model = fit(candidates(docs.select(F.col(text_col).alias("_text")), "_text"))
    names = docs.columns
    rows = candidates(docs.select(F.struct(*map(quoted, names)).alias("_row"), F.col(text_col).alias("_text")), "_text")
    # Each step is a column of its own that the next refers to more than once, so that Spark computes it once.
    # Sums start anew with each pattern: what they were before its first match is taken off.
    rows = rows.withColumn("_sums", _running(F.transform("_found", lambda c: c["gap"].cast("long") + c["n"]), _add))
    # Kinds lie one after the other on an axis, so that one running value serves all of them.
    rows = rows.withColumn("_kept", F.array_sort(F.filter(F.transform("_found", lambda c, i: F.when(kept(c, model), F.struct(
        (F.get("_sums", i) - F.coalesce(F.get("_sums", i - c["at"] - 1), F.lit(0)) - c["n"] + c["kind"] * AXIS).alias("start"),
        (F.get("_sums", i) - F.coalesce(F.get("_sums", i - c["at"] - 1), F.lit(0)) + c["kind"] * AXIS).alias("end"),
        (c["strict"] == 1).alias("base")))), lambda s: s.isNotNull())))
    rows = rows.select(
        "*", _running(F.transform("_kept", lambda s: F.when(s["base"], s["end"])), F.greatest).alias("_before"),
        F.reverse(_running(F.transform(F.reverse("_kept"), lambda s: F.when(s["base"], s["start"])), F.least)).alias("_after"))
    free = F.filter("_kept", lambda s, i: s["base"] | ~(
        F.coalesce(F.get("_before", i - 1) > s["start"], F.lit(False))
        | F.coalesce(F.get("_after", i + 1) < s["end"], F.lit(False))))
    rows = rows.withColumn("_spans", F.array_sort(F.transform(free, lambda s: F.struct(
        (s["start"] % AXIS).alias("start"), (-(s["end"] % AXIS)).alias("back"), F.floor(s["start"] / AXIS).cast("int").alias("kind")))))
    some = F.size("_spans") > 0
    rows = rows.select("*", _running(F.transform("_spans", lambda s: -s["back"]), F.greatest).alias("_reach"),
                       F.when(some, F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))).alias("_chunks"))
    tags = F.array(*(F.lit(f"[{k.name.upper()}]") for k in KINDS))

    def put(s: Column, i: Column) -> Column:
        done = F.coalesce(F.get("_reach", i - 1), F.lit(0))
        return F.when(s["start"] >= done, F.concat(_piece(done, s["start"]), F.get(tags, s["kind"]))).otherwise("")

    rest = _piece(F.element_at("_reach", -1), F.char_length("_text").cast("long"))
    cut = F.when(some, F.concat(F.array_join(F.transform("_spans", put), ""), rest)).otherwise(F.col("_text"))
    rows = rows.select("_row", some.alias("_some"), cut.alias("_text"))
    for kind, tag in ((k, f"[{k.name.upper()}]") for k in KINDS):
        rows = rows.select("_row", "_some", "_text", F.when(F.col("_some"), F.split("_text", kind.strict, -1)).alias("_gaps"),
                           F.regexp_extract_all("_text", F.lit(kind.strict), F.lit(0)).alias("_hits"))
        filled = F.zip_with("_gaps", "_hits", lambda g, m: F.concat(  # noqa: B023
            g, F.when(m.isNull(), "").when(passes(kind.name, m), tag).otherwise(m)))
        rows = rows.select("_row", "_some", F.coalesce(F.array_join(filled, ""), F.col("_text")).alias("_text"))
    return rows.select(*(F.col("_text").alias(n) if n == text_col else F.col("_row")[n].alias(n) for n in names))


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the strict spans and all spans as text, from :func:`find`."""
    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(F.array(*(F.lit(k.name) for k in KINDS)), s["kind"] + 1),
            s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["base"])

    def count(i: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")

    counts = [count(i).alias(f"n_{k.name}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"))
