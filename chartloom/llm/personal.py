"""Personal data: base patterns, and further spans that boosted trees accept.

Base spans are leftmost, non-overlapping matches of one pattern per kind, dropped
where a check of the match fails.  They are found without positions in the regex
engine: the text between matches (a split) and the matches themselves give the
offsets, in code points.  The patterns start only where a run starts or the last
match ended, and never give back characters, so long runs take linear time; offsets
are summed in blocks, so many matches do too.

High-recall generators propose more spans: written-out e-mail addresses, phone
numbers without a country code, long digit groups of any check sum, and dotted
numbers.  The generator of a kind reads the text with the kind's base spans blanked
out, so its proposals overlap none of them, but may overlap other kinds.  A proposal
is described by its format and its context.

Gradient-boosted trees learn from what the base knows.  Positive are its spans and
disguises made of them on purpose (written out, other separators, no country code);
negative are spans broken on purpose and proposals of the corpus that fail the check
of their kind (check sum, range, number of digits).  Proposals that pass it have no
label and are judged.  Each kind has a threshold of its own, the least score at which
labelled rows held out by value reach the wanted precision, moved half-way to the next
lower of them and to one half at least; a kind without held-out
rows of both labels adds no spans.

Only DataFrame functions and Spark's own boosted trees run here.  The fit takes all
labelled rows; rows of equal features are one, with their number as weight.  NULL texts are empty and, like texts
without matches, have no spans.  Repeated rows are scanned alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import let, stored, whole_text
from chartloom.llm.graph import attach

PRECISION = 0.98
NO_SPANS = "array<struct<start:int,end:int>>"

# The kinds in their order, with their patterns (possessive, guarded).
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A cheap sign that a text may hold the kind at all.
SIGNS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Check sum of a digit string: every second digit from the right doubled."""
    places = F.split(F.reverse(digits), "")
    parts = F.transform(
        F.array_remove(places, ""),
        lambda c, i: let(
            c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda d: F.when(d > 9, d - 9).otherwise(d)
        ),
    )
    return F.aggregate(parts, F.lit(0), lambda total, d: total + d) % 10 == 0


def check(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern stands."""
    digits = digits_of(value)
    if kind == "ip":
        return F.forall(
            F.split(value, r"\."),
            lambda p: let(
                F.regexp_replace(p, "^0+(?=.)", ""),
                lambda q: F.when(F.length(q) <= 3, F.coalesce(q.try_cast("int") <= 255, F.lit(False))).otherwise(False),
            ),
        )
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


_PLACED = "array<struct<start:int,end:int,value:string>>"
_BLOCK = 256


def located(text: Column, pattern: str, sign: str) -> Column:
    """array<struct<start, end, value>> of all matches, in code points."""

    def inside(block: Column) -> Column:
        """Matches of a block with offsets from its start, and its length."""

        def add(done: Column, pair: Column) -> Column:
            begin = done["at"] + F.length(pair["gap"])
            end = begin + F.length(pair["value"])
            span = F.struct(begin.alias("start"), end.alias("end"), pair["value"].alias("value"))
            return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

        return F.aggregate(block, F.struct(F.lit(0).alias("at"), F.array().cast(_PLACED).alias("out")), add)

    def joined(blocks: Column) -> Column:
        sums = F.aggregate(
            blocks, F.array(F.lit(0)), lambda done, b: F.concat(done, F.array(F.element_at(done, -1) + b["at"]))
        )

        def moved(found: Column, at: Column) -> Column:
            return F.transform(
                found, lambda m: F.struct((m["start"] + at).alias("start"), (m["end"] + at).alias("end"), m["value"].alias("value"))
            )

        def shifted(begins: Column) -> Column:
            return F.flatten(F.transform(blocks, lambda b, i: let(F.get(begins, i), lambda at: moved(b["out"], at))))

        return let(sums, shifted)

    def place(found: Column) -> Column:
        pairs = F.zip_with(
            F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda g, v: F.struct(g.alias("gap"), v.alias("value"))
        )

        def blocks(rows: Column) -> Column:
            starts = F.sequence(F.lit(1), F.size(rows), F.lit(_BLOCK))
            return F.transform(starts, lambda i: inside(F.slice(rows, i, F.lit(_BLOCK))))

        return let(let(pairs, blocks), joined)

    some = F.when(text.rlike(sign), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return let(some, lambda found: F.when(F.size(found) > 0, place(found)).otherwise(F.array().cast(_PLACED)))


def blanked(text: Column, kind: str) -> Column:
    """The text with its base spans of a kind replaced by as many control characters."""
    pattern = PATTERNS[kind]
    blank = F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda v: F.when(check(kind, v), F.repeat(F.lit("\x01"), F.length(v))).otherwise(v),
    )
    parts = F.zip_with(F.split(text, pattern, -1), blank, lambda g, v: F.concat(g, F.coalesce(v, F.lit(""))))
    return F.when(text.rlike(SIGNS[kind]), F.array_join(parts, "")).otherwise(text)


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(located(text, PATTERNS[kind], SIGNS[kind]), lambda m: check(kind, m["value"]))


@dataclass(frozen=True)
class Generator:
    kind: str
    pattern: str
    sign: str


# High-recall patterns; each may propose what the base has too.
GENERATORS = (
    Generator("email", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++\x20?(?:@|\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]++(?:(?:\.|\x20dot\x20|\[dot\]|\(dot\))[A-Za-z0-9-]++)++", r"@|\(at\)|\[at\]|\x20at\x20\S+\x20dot\x20|\x20dot\x20"),
    Generator("ip", r"(?:(?<![0-9.])|\G)[0-9]++(?:\.[0-9]++){3,}+", SIGNS["ip"]),
    Generator("card", r"(?:(?<![0-9])|\G)[0-9](?:[\x20.-]?+[0-9]){12,18}+(?![0-9])", r"[0-9](?:[\x20.-]?[0-9]){12}"),
    Generator("phone", r"(?<![0-9.+])(?:\+?[0-9]{1,3}[\x20.-])?(?:\([0-9]{2,4}\)[\x20/-]?[0-9]{3,4}[\x20/-]?[0-9]{2,4}|[0-9]{3,4}[/-][0-9]{3,4}[/-][0-9]{3,4})(?![0-9.])|\+[0-9](?:[\x20().-]*+[0-9]){8,14}+", r"[0-9]\)|[0-9][/-][0-9]|\+[0-9]"),
)
FEATURES = (
    "email", "ip", "card", "phone", "length", "digits", "letters", "groups", "separators", "sum_ok", "range_ok",
    "brackets", "dots", "same_digit", "before_letter", "after_letter", "before_digit", "after_digit",
    "cue_before", "line_share",
)
_CUE = r"(?i)(?:mail|phone|tel|call|fax|card|visa|iban|account|host|addr|ip|server|contact|write|an|at|von|de)\W*$"


_DESCRIBED = "array<struct<kind:string,start:int,end:int,value:string,before:string,after:string>>"


def _with_context(text: Column, spans: Column, kind: str) -> Column:
    return F.transform(
        spans,
        lambda m: F.struct(
            F.lit(kind).alias("kind"),
            m["start"].alias("start"),
            m["end"].alias("end"),
            m["value"].alias("value"),
            F.substring(text, F.greatest(m["start"] - 23, F.lit(1)), F.least(m["start"], F.lit(24))).alias("before"),
            F.substring(text, m["end"] + 1, F.lit(12)).alias("after"),
        ),
    )


def proposals(text: Column) -> Column:
    """array<struct<kind, start, end, value, before, after>> of all generators, beside the base spans."""

    def of(g: Generator) -> Column:
        return F.when(
            text.rlike(g.sign),
            let(blanked(text, g.kind), lambda rest: _with_context(text, located(rest, g.pattern, g.sign), g.kind)),
        ).otherwise(F.array().cast(_DESCRIBED))

    return F.concat(*(of(g) for g in GENERATORS))


def known_spans(text: Column) -> Column:
    """Base spans of all kinds with value and context."""
    return F.concat(F.array().cast(_DESCRIBED), *(_with_context(text, base_spans(text, k), k) for k in KINDS))


def _grouped(digits: Column, sizes: tuple[int, ...], between: str) -> Column:
    """Digits in groups, the rest behind the last."""
    parts, at = [], 1
    for n in sizes:
        parts.append(F.substring(digits, at, n))
        at += n
    parts[-1] = F.concat(parts[-1], F.substr(digits, F.lit(at)))
    return F.concat_ws(between, *parts)


def disguises(value: Column, kind: str) -> list[Column]:
    """Other ways to write what a base span says."""
    digits = digits_of(value)
    if kind == "email":
        host = F.substring_index(value, "@", -1)
        name = F.substring_index(value, "@", 1)
        return [
            F.concat(name, F.lit(a), F.replace(host, F.lit("."), F.lit(d)))
            for a, d in ((" at ", " dot "), ("(at)", "."), (" [at] ", "[dot]"), ("@", "(dot)"))
        ]
    if kind == "card":
        return [_grouped(digits, (4, 4, 4, 4), x) for x in (".", "-", " ")]
    if kind == "phone":
        own = F.when(F.length(digits) >= 10, F.right(digits, F.lit(10)))
        return [_grouped(own, (3, 3, 4), "-"), F.concat(F.lit("("), F.left(own, F.lit(3)), F.lit(") "), _grouped(F.right(own, F.lit(7)), (3, 4), "-"))]
    return []


def breakages(value: Column, kind: str) -> list[Column]:
    """Spans of the same make that say nothing: a wrong check sum, numbers out of range, too few digits."""
    digits = digits_of(value)
    if kind == "email":
        return [F.regexp_replace(value, "@.*", " at 5 dot 30"), F.regexp_replace(value, "@.*", " at x dot y")]
    if kind == "card":
        wrong = F.concat(F.left(digits, F.length(digits) - 1), ((F.right(digits, F.lit(1)).cast("int") + 1) % 10).cast("string"))
        return [wrong, _grouped(wrong, (4, 4, 4, 4), "-"), _grouped(wrong, (4, 4, 4, 4), ".")]
    if kind == "phone":
        short = F.left(digits, F.lit(7))
        return [_grouped(short, (3, 4), "-"), _grouped(F.left(digits, F.lit(8)), (4, 4), "/"), F.concat(F.lit("+"), F.repeat(digits, 2))]
    return [F.concat(value, F.lit(".7")), F.regexp_replace(value, r"\.[0-9]+$", ".990"), F.concat(F.lit("4"), F.lit("00."), F.regexp_replace(value, r"^[0-9]+\.", ""))]


def fails(kind: Column, value: Column) -> Column:
    """Whether a proposal cannot be data of its kind by its check."""
    digits = F.length(digits_of(value))
    return (
        F.when(kind == "card", ~check("card", value))
        .when(kind == "ip", ~(value.rlike(r"^[0-9]+(\.[0-9]+){3}$") & check("ip", value)))
        .when(kind == "phone", ~digits.between(9, 15))
        .otherwise(~value.rlike(r"[A-Za-z]{2,24}$"))
    )


def labelled_rows(known: DataFrame, proposed: DataFrame) -> DataFrame:
    """(origin, kind, value, before, after, label) from base spans and from proposals that fail; origin is the real value."""
    columns = ["origin", "kind", "value", "before", "after"]
    base = known.select(F.col("value").alias("origin"), "kind", "value", "before", "after")
    # Made spans and real ones also stand in plain words, so that a cue helps but is not asked for.
    base = base.union(base.withColumns({"before": F.lit("and somewhere in a line "), "after": F.lit(" of the text")}))
    parts = [base.select(*columns, F.lit(1).alias("label"))]
    for kind in KINDS:
        of = base.filter(F.col("kind") == kind)
        for label, made in ((1, disguises(F.col("value"), kind)), (0, breakages(F.col("value"), kind))):
            if made:
                each = of.withColumn("value", F.explode(F.array_compact(F.array(*made))))
                parts.append(each.select(*columns, F.lit(label).alias("label")))
    failed = proposed.filter(fails(F.col("kind"), F.col("value"))).withColumn("origin", F.col("value"))
    parts.append(failed.select(*columns, F.lit(0).alias("label")))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.dropDuplicates(["kind", "value", "before", "after", "label"])


def described(rows: DataFrame) -> DataFrame:
    """rows of proposals with the array `x` of FEATURES."""
    value, kind = F.col("value"), F.col("kind")
    digits = digits_of(value)
    n = F.length(value)

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / n

    flags = {
        **{k: kind == k for k in KINDS},
        "length": n,
        "digits": F.length(digits),
        "letters": share("[A-Za-z]"),
        "groups": F.size(F.split(value, "[^0-9A-Za-z]+")),
        "separators": share(r"[\x20./-]"),
        "sum_ok": luhn(digits),
        "range_ok": check("ip", value) & value.rlike(r"^[0-9.]+$"),
        "brackets": value.contains("("),
        "dots": F.regexp_count(value, F.lit(r"\.")),
        "same_digit": digits.rlike("^([0-9])\\1*$"),
        "before_letter": F.col("before").rlike(r"\p{L}$"),
        "after_letter": F.col("after").rlike(r"^\p{L}"),
        "before_digit": F.col("before").rlike(r"[0-9]$"),
        "after_digit": F.col("after").rlike("^[0-9]"),
        "cue_before": F.col("before").rlike(_CUE),
        "line_share": n / (n + F.length("before") + F.length("after")),
    }
    return rows.withColumn("x", F.array(*(F.coalesce(flags[f].cast("double"), F.lit(0.0)) for f in FEATURES)))


def _base(text: Column) -> Column:
    """array<struct<kind, start, end>>, kinds in order, then by start."""

    def of(kind: str) -> Column:
        return F.transform(
            base_spans(text, kind),
            lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")),
        )

    return F.concat(*(of(kind) for kind in KINDS))


@dataclass(frozen=True)
class Detector:
    model: object
    thresholds: dict[str, float]


def fit(labelled: DataFrame, rounds: int = 10, depth: int = 3, precision: float = PRECISION):
    """Boosted trees and a threshold per kind; None where there is one label only."""
    apart = (F.pmod(F.xxhash64("origin"), F.lit(4)) == 0).alias("apart")
    alike = described(labelled).groupBy("kind", "x", "label", apart).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    rows = stored(alike, "labelled").select(
        "kind", array_to_vector("x").alias("features"), F.col("label").cast("double").alias("label"), "apart", "weight"
    )
    if rows.select("label").distinct().count() < 2:
        return None
    learned = rows.filter("NOT apart")
    if learned.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=5, weightCol="weight").fit(learned)
    judged = model.transform(rows.filter("apart")).select(
        "kind", F.floor(vector_to_array("probability")[1] * 100).cast("int").alias("bin"), "label", "weight"
    )
    bins = judged.groupBy("kind", "bin").agg(F.sum("weight").alias("n"), F.sum(F.col("label") * F.col("weight")).alias("good")).orderBy("kind", F.desc("bin"))
    thresholds: dict[str, float] = {}
    seen: dict[str, tuple[float, float]] = {}
    lowest: dict[str, int] = {}
    for row in bins.collect():  # at most 101 bins a kind
        kind, at = row["kind"], row["bin"]
        if kind in lowest and kind not in thresholds:  # half-way to the next lower rows
            thresholds[kind] = max((lowest[kind] + at + 1) / 200, 0.5)
        n, good = seen.get(kind, (0.0, 0.0))
        seen[kind] = n, good = n + row["n"], good + row["good"]
        if good >= precision * n:
            lowest[kind] = at
            thresholds.pop(kind, None)
    thresholds |= {k: 0.5 for k in lowest if k not in thresholds}
    both = {k for k, (n, good) in seen.items() if 0 < good < n}
    return Detector(model, {k: t for k, t in thresholds.items() if k in both})


def detect(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """docs with `base` and `spans`: arrays of struct<kind, start, end>; columns of these names are replaced."""
    docs = docs.drop("base", "spans")
    whole = whole_text(text)
    key = F.unhex(F.md5(whole))
    found = stored(
        docs.select(key.alias("__key"), whole.alias("t"))
        .filter(F.col("t").rlike("|".join([*SIGNS.values(), *(g.sign for g in GENERATORS)])))
        .select("__key", known_spans(F.col("t")).alias("known"), proposals(F.col("t")).alias("p"))
        .filter((F.size("known") > 0) | (F.size("p") > 0))
        .withColumn("base", F.transform("known", lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end")))),
        "proposals",
    )
    known = found.select(F.explode("known").alias("m")).select("m.*")
    proposed = found.select("__key", F.explode("p").alias("p")).select("__key", "p.*")
    detector = fit(labelled_rows(known, proposed), **options)
    if detector is None or not detector.thresholds:
        added = None
    else:
        limit = F.coalesce(*(F.when(F.col("kind") == k, F.lit(t)) for k, t in detector.thresholds.items()))
        judged = detector.model.transform(described(proposed.filter(~fails(F.col("kind"), F.col("value")))).withColumn("features", array_to_vector("x")))
        good = judged.withColumn("score", vector_to_array("probability")[1]).filter(F.col("score") >= limit)
        # One generator per kind: accepted spans of a kind do not overlap.
        added = good.groupBy("__key").agg(F.sort_array(F.collect_set(F.struct("kind", "start", "end"))).alias("more"))
    bases = found.select("__key", "base").filter("size(base) > 0").dropDuplicates(["__key"])
    if added is not None:
        bases = bases.join(added, "__key", "full_outer")
    else:
        bases = bases.withColumn("more", F.lit(None).cast("array<struct<kind:string,start:int,end:int>>"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    order = F.array(*(F.lit(k) for k in KINDS))
    together = F.transform(
        F.array_sort(
            F.transform(
                F.concat(F.coalesce("base", none), F.coalesce("more", none)),
                lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
            )
        ),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    spans = stored(bases.select("__key", F.coalesce("base", none).alias("base"), together.alias("spans")), "spans")
    rows = attach(docs.withColumn("__key", key), spans, "__key", "left")
    return rows.withColumns({"base": F.coalesce("base", none), "spans": F.coalesce("spans", none)}).drop("__key")


def written(spans: Column | str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts and fingerprint of the base spans, and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *(count(k) for k in KINDS), F.sha2(written("base").cast("binary"), 256).alias("base_sha256"), written("spans").alias("spans"))


def redact(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """docs with the spans of all kinds replaced by [KIND]; overlapping spans merge into the first."""
    own = {c: f"__{c}" for c in ("base", "spans") if c in docs.columns}
    found = detect(docs.withColumnsRenamed(own), text, **options)
    ranked = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    whole = F.col(text)
    replaced = F.aggregate(
        ranked,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda done, s: F.when(
            s["start"] >= done["at"],
            F.struct(
                F.concat(
                    done["out"],
                    F.substr(whole, done["at"] + 1, s["start"] - done["at"]),
                    F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")),
                ).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(F.struct(done["out"].alias("out"), F.greatest(done["at"], s["end"]).alias("at"))),
        lambda done: F.concat(done["out"], F.substr(whole, done["at"] + 1)),
    )
    cleaned = found.withColumn(text, F.when(F.size("spans") > 0, replaced).otherwise(whole)).drop("base", "spans")
    return cleaned.withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)
