"""Personal data by gradient-boosted candidates, in DataFrame operations only.

Generators of high recall propose spans that may overlap. Format and context of
a candidate become a few small numbers. Boosted trees are fitted on the counts
of every distinct feature row of the corpus and turned into a column expression,
so scoring stays inside the row: nothing is shuffled. Labels are the checks that
the base patterns carry (checksum, ranges, digit counts) and rules of format and
context for the wider spellings. A threshold per generator is calibrated on
held-out documents.

Base spans are always kept; a generated span is added when it touches none of
them and scores at or above its generator's threshold. Null and empty texts have no
spans, repeated rows give equal rows, an empty table gives an empty one (and no
trees), null ids stay null, and columns other than ``doc_id`` and ``text`` are
ignored or, by ``redact``, passed through. Positions are code points. Very long
texts stay in their row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspark.llm.rows import packed, unpacked
from roadspark.runtime import use_checkpoints, written

KINDS = ["email", "ip", "card", "phone"]
# Patterns start at the head of a run of their first characters or where the last match ended, which
# finds the same leftmost matches without trying every place of a long run.
_HEAD = r"(?:(?<![{0}])|\G)"
BASE = {
    "email": _HEAD.format("A-Za-z0-9._%+-") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _HEAD.format("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": _HEAD.format("0-9") + r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What the base patterns leave out: spelled-out addresses, numbers without a plus, other separators.
WIDER = {
    "email": _HEAD.format("A-Za-z0-9._%+-")
    + r"[A-Za-z0-9._%+-]++ ?(?i:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]++(?: ?(?i:\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}(?:[0-9A-Fa-f]{1,4})?(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[./_ ][0-9]{4}){3}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?<![0-9][-./])(?:00[1-9][0-9]{0,2}[ .-]?|1[ .-])?(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ ./-])[0-9]{2,8}(?:[ ./-][0-9]{2,8}){0,3}(?![0-9A-Za-z])",
}
# What a text must hold for a pattern to match anywhere.
NEEDS = {
    ("email", True): "@", ("email", False): r"(?i)[(\[{]at[)\]}]", ("ip", True): r"[0-9]\.[0-9]",
    ("ip", False): "[0-9A-Fa-f]:[0-9A-Fa-f:]", ("card", True): "[0-9][ -]?[0-9]", ("card", False): "[0-9]{4}[./_ ][0-9]{4}",
    ("phone", True): r"\+[0-9]", ("phone", False): r"[0-9]\)?[ ./-]?[0-9]{2}",
}
FEATURES = [
    "kind", "digits", "separators", "groups", "plus", "bracket", "same_digits", "checksum", "octets",
    "left", "right", "hint", "dots", "size", "wide", "format", "calls",
]
_HINTS = r"(?i)(mail|contact|write|card|visa|credit|kart|carte|tarjeta|phone|tel|call|fax|ip|host|addr|server)"
_CALLS = r"(?i)(?<![a-z])(phone|telephone|tel|call|fax|mobile|cell)"
# Documents of this remainder calibrate the thresholds and are not fitted on.
HELD_OUT, FOLDS = 0, 5
PRECISION = 0.9


def _spans(kind: str, base: bool) -> tuple[Column, Column]:
    """All matches of one generator, and the text between them."""
    pattern = (BASE if base else WIDER)[kind]
    none = F.array().cast("array<string>")
    found = F.when(F.col("_text").rlike(NEEDS[kind, base]), F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))).otherwise(none)
    between = F.when(F.size(F.col("_found")) > 0, F.split("_text", pattern, -1)).otherwise(none)
    return found, between


def _located(df: DataFrame, kind: str, base: bool) -> DataFrame:
    """Add the column of one generator's candidates.

    The text between matches, as ``split`` gives it, has the same order as the
    matches, so running lengths of both are the places.
    """
    found, between = _spans(kind, base)
    steps = F.zip_with(
        F.transform("_found", lambda hit, i: F.struct(hit.alias("hit"), F.try_element_at("_between", i + 2).alias("after"))),
        F.slice("_between", 1, F.size("_found")),
        lambda x, before: F.struct(x["hit"].alias("hit"), before.alias("before"), x["after"].alias("after")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_CANDIDATES).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["before"])
        end = begin + F.length(x["hit"])
        candidate = F.struct(
            begin.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), F.lit(base).alias("base"),
            x["hit"].alias("hit"), F.right(x["before"], F.lit(24)).alias("left"), F.left(x["after"], F.lit(1)).alias("right"),
        )
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(candidate)).alias("out"))

    name = f"_{kind}_{'base' if base else 'wider'}"
    df = df.withColumn("_found", found).withColumn("_between", between)
    return df.withColumn(name, F.aggregate(steps, start, step, lambda acc: acc["out"])).drop("_found", "_between")


_CANDIDATES = (
    "array<struct<start:int,kind:int,end:int,base:boolean,hit:string,left:string,right:string>>"
)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), lambda d, i: F.struct(d.cast("int").alias("d"), i.alias("i")))
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    total = F.aggregate(
        places, F.lit(0), lambda acc, p: acc + F.when(p["i"] % 2 == 1, doubled(p["d"])).otherwise(p["d"])
    )
    return total % 10 == 0


def _octets(hit: Column) -> Column:
    """Whether four dotted numbers are at most 255; longer numbers fail without a cast."""
    parts = F.split(hit, r"\.")
    short = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.forall(parts, lambda p: (F.length(short(p)) <= 3) & (short(p).try_cast("int") <= 255))


def _valid(x: Column) -> Column:
    """The base patterns' own checks."""
    kind, digits = x["kind"], F.length(_digits(x["hit"]))
    return (
        F.when(kind == 0, F.lit(True))
        .when(kind == 1, _octets(x["hit"]))
        .when(kind == 2, digits.between(12, 19) & _luhn(_digits(x["hit"])))
        .otherwise(digits.between(9, 15))
    )


def _format(x: Column) -> Column:
    """2 if a candidate's own form is proof enough, 1 if it needs context, 0 if the form is wrong."""
    hit = x["hit"]
    digits = _digits(hit)
    n = F.length(digits)
    groups = F.size(F.filter(F.split(hit, ":"), lambda g: g != ""))
    folded = (F.size(F.split(hit, "::")) == 2) & ~hit.contains(":::") & ~hit.rlike("^:[^:]") & ~hit.rlike("[^:]:$")
    address = F.when(hit.contains("::"), folded & groups.between(2, 7) & hit.rlike("^[0-9A-Fa-f]{3,4}:")).otherwise(
        (groups == 8) & ~hit.rlike("^:|:$")
    ) & hit.rlike("[0-9]")
    american = hit.rlike(r"^(?:1[ .-])?\(?[2-9][0-9]{2}\)?[ .-]?[2-9][0-9]{2}[ .-][0-9]{4}$")
    plain = hit.rlike(r"^(?:1([.-]))?[2-9][0-9]{2}([.-])[2-9][0-9]{2}\2[0-9]{4}$") | (american & hit.contains("("))
    abroad = hit.rlike(r"^00[1-9]") & n.between(9, 17)
    trunk = hit.rlike(r"^\(?0[1-9]") & n.between(9, 12)
    phone = F.when(plain | abroad, 2).when(american | trunk, 1).otherwise(0)
    wider = (
        F.when(x["kind"] == 0, F.when(hit.rlike(r"(?:[)\]}] ?|\.)[A-Za-z]{2,}$"), 2).otherwise(0))
        .when(x["kind"] == 1, F.when(address, 2).otherwise(0))
        .when(x["kind"] == 2, F.when(_luhn(digits), 2).otherwise(0))
        .otherwise(phone)
    )
    return F.when(x["base"], F.when(_valid(x), 2).otherwise(0)).otherwise(wider)


def _label(x: Column) -> Column:
    """Whether format and context make a candidate personal data: 1 or 0."""
    form = _format(x)
    context = x["left"].rlike(_CALLS) | x["hit"].contains("(")
    return F.when((form == 2) | ((form == 1) & context), 1).otherwise(0)


def _features(x: Column) -> dict[str, Column]:
    """Small numbers that describe a candidate's format and context."""
    hit, digits = x["hit"], _digits(x["hit"])
    n = F.length(digits)
    capped = lambda c, most: F.least(c, F.lit(most))
    edge = lambda c: F.when(c.rlike(r"[0-9A-Za-z]"), 2).when(c.rlike(r"[\s]") | (c == ""), 0).otherwise(1)
    flag = lambda c: c.cast("int")
    values = {
        "kind": x["kind"],
        "digits": capped(n, 20),
        "separators": capped(F.length(F.regexp_replace(hit, r"[^ .\-/_ :]", "")), 8),
        "groups": capped(F.size(F.split(hit, "[^0-9]+")), 8),
        "plus": flag(hit.startswith("+") | hit.startswith("00")),
        "bracket": flag(hit.contains("(") | hit.contains("[")),
        "same_digits": flag(hit.rlike(r"([0-9])(?:[^0-9]*\1){7}")),
        "checksum": flag(F.when(n.between(12, 19), _luhn(digits)).otherwise(False)),
        "octets": flag(F.when(hit.rlike(r"^[0-9]+(\.[0-9]+){3}$"), _octets(hit)).otherwise(False)),
        "left": edge(F.right(x["left"], F.lit(1))),
        "right": edge(F.coalesce(x["right"], F.lit(""))),
        "hint": flag(x["left"].rlike(_HINTS)),
        "dots": capped(F.length(F.regexp_replace(hit, "[^.]", "")), 4),
        "size": capped(F.floor(F.length(hit) / 4).cast("int"), 10),
        "wide": flag(~x["base"]),
        "format": _format(x),
        "calls": flag(x["left"].rlike(_CALLS)),
    }
    return {name: F.coalesce(values[name], F.lit(0)).cast("int").alias(name) for name in FEATURES}


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base`` (valid base spans) and ``_wider`` (all other candidates)."""
    df = docs.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    for kind in KINDS:
        df = _located(_located(df, kind, True), kind, False)
    base = F.concat(*[F.col(f"_{k}_base") for k in KINDS])
    wider = F.concat(*[F.col(f"_{k}_wider") for k in KINDS])
    df = df.withColumn("_matched", F.transform(base, lambda x: F.struct(x.alias("x"), _valid(x).alias("ok"))))
    ok = lambda want: F.transform(F.filter("_matched", lambda m: m["ok"] == want), lambda m: m["x"])
    df = df.withColumn("_base", F.array_sort(ok(True))).withColumn("_wider", F.concat(ok(False), wider))
    return df.drop("_matched", *[f"_{k}_{s}" for k in KINDS for s in ("base", "wider")])


def _touches(x: Column, spans: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))


def feature_counts(docs: DataFrame) -> DataFrame:
    """Every distinct feature row with its label, side and count.

    Features are small bounded numbers, so there are few rows whatever the size
    of the corpus, and they are summed before they are shuffled. A base match is
    positive if it passes its check, a wider candidate if format and context
    speak for it. Candidates that touch a valid base span can never be added and
    are left out.
    """
    side = (F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_OUT).alias("held_out")
    free = F.filter("_wider", lambda x: ~_touches(x, F.col("_base")))
    labelled = F.concat(
        F.transform("_base", lambda x: F.struct(x.alias("x"), F.lit(1).alias("label"))),
        F.transform(free, lambda x: F.struct(x.alias("x"), _label(x).alias("label"))),
    )
    rows = candidates(docs.select("doc_id", "text")).where((F.size("_base") > 0) | (F.size("_wider") > 0)).select(side, F.explode(labelled).alias("c"))
    features = list(_features(F.col("c.x")).values())
    return (
        rows.select("held_out", F.col("c.label").cast("double").alias("label"), *features)
        .groupBy("held_out", "label", *FEATURES).agg(F.count("*").alias("n"))
    )


class CandidateModel:
    """Boosted trees over candidate features, as an expression, and a threshold per generator.

    Without trees, the labels' own rules decide.
    """

    def __init__(self, trees: list[tuple[float, dict]], thresholds: dict[int, float]):
        self.trees = trees
        self.thresholds = thresholds

    def margin(self, value) -> Column:
        """Sum of the trees; ``value(name)`` gives a feature's column."""
        if not self.trees:
            return F.lit(float("-inf"))

        def branch(node: dict) -> Column:
            if "value" in node:
                return F.lit(node["value"])
            test = value(FEATURES[node["feature"]]) <= F.lit(node["threshold"])
            return F.when(test, branch(node["left"])).otherwise(branch(node["right"]))

        return reduce(lambda a, b: a + b, [F.lit(weight) * branch(tree) for weight, tree in self.trees])

    def accepts(self, x: Column) -> Column:
        """Whether a candidate scores at or above its generator's threshold."""
        if not self.trees:
            return _label(x) == 1
        features = _features(x)
        score = self.margin(features.__getitem__)
        limit = reduce(
            lambda rest, g: F.when(_generator(features["kind"], features["wide"]) == g, F.lit(self.thresholds[g])).otherwise(rest),
            self.thresholds, F.lit(float("inf")),
        )
        return score >= limit


def _generator(kind: Column, wide: Column) -> Column:
    return kind + len(KINDS) * wide


def _tree(node) -> dict:
    if node.getClass().getSimpleName() == "LeafNode":
        return {"value": float(node.prediction())}
    split = node.split()
    return {
        "feature": int(split.featureIndex()), "threshold": float(split.threshold()),
        "left": _tree(node.leftChild()), "right": _tree(node.rightChild()),
    }


def calibrated(scored: list[tuple[int, float, float, int]], precision: float = PRECISION) -> dict[int, float]:
    """Per generator the lowest margin at or above which held-out candidates reach ``precision``.

    ``scored`` holds (generator, margin, label, count); the generators are the base
    patterns and then the wider ones. One without held-out candidates of both
    labels is cut at margin 0.
    """
    limits = {}
    for generator in range(2 * len(KINDS)):
        own = sorted([s for s in scored if s[0] == generator], key=lambda s: -s[1])
        limits[generator] = 0.0
        if len({s[2] for s in own}) < 2:
            continue
        good = seen = 0
        best = float("inf")
        for i, (_, margin, label, count) in enumerate(own):
            seen += count
            good += count * int(label)
            last = i + 1 == len(own) or own[i + 1][1] < margin
            if last and good >= precision * seen:
                best = margin
        limits[generator] = best
    return limits


def fit(docs: DataFrame, trees: int = 12, depth: int = 4) -> CandidateModel:
    """Fit on the corpus' feature counts; without candidates of both labels there are no trees."""
    counts = written(feature_counts(docs), "pii-features").coalesce(1)
    train = counts.where(~F.col("held_out"))
    if train.select("label").distinct().count() < 2:
        return CandidateModel([], {})
    use_checkpoints(docs.sparkSession)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        train.withColumn("weight", F.log1p("n").cast("double"))
    )
    fitted = GBTClassifier(
        maxIter=trees, maxDepth=depth, stepSize=0.3, maxBins=32, weightCol="weight", seed=1
    ).fit(rows)
    grown = [
        (float(w), _tree(t.rootNode())) for w, t in zip(fitted.treeWeights, fitted._java_obj.trees())
    ]
    model = CandidateModel(grown, {})
    held = counts.where("held_out").select(_generator(F.col("kind"), F.col("wide")), model.margin(F.col).alias("margin"), "label", "n")
    model.thresholds = calibrated([tuple(r) for r in held.collect()])  # few rows: distinct feature values
    return model


def _chosen(df: DataFrame, model: CandidateModel) -> DataFrame:
    """Add ``_spans``: base spans and accepted candidates that touch neither them nor an earlier one."""
    free = F.filter("_wider", lambda x: ~_touches(x, F.col("_base")) & model.accepts(x))
    apart = F.aggregate(
        F.array_sort(free), F.array().cast(_CANDIDATES),
        lambda acc, x: F.when(_touches(x, acc), acc).otherwise(F.concat(acc, F.array(x))),
    )
    return df.withColumn("_added", F.when(F.size("_wider") > 0, apart).otherwise(F.array().cast(_CANDIDATES))).withColumn(
        "_spans", F.array_sort(F.concat("_base", "_added"))
    ).drop("_added")


def detect(docs: DataFrame, model: CandidateModel) -> DataFrame:
    """doc_id, base spans and all spans, as arrays of struct<start, kind, end, ...> by start and kind."""
    return _chosen(candidates(docs.select("doc_id", "text")), model).select(
        "doc_id", F.col("_base").alias("base"), F.col("_spans").alias("spans")
    )


def redact(docs: DataFrame, model: CandidateModel) -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets; all rows and columns stay."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        kept = F.substring(F.col("_text"), acc["at"] + 1, x["start"] - acc["at"])
        more = F.concat(acc["out"], F.array(kept, F.element_at(names, x["kind"] + 1)))
        inside = x["start"] < acc["at"]
        return F.struct(
            F.when(inside, F.greatest(acc["at"], x["end"])).otherwise(x["end"]).alias("at"),
            F.when(inside, acc["out"]).otherwise(more).alias("out"),
        )

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), F.substring(F.col("_text"), acc["at"] + 1, F.length("_text")))

    marked = F.aggregate("_spans", start, step, finish)
    found = _chosen(candidates(packed(docs, F.col("text"))), model)
    return unpacked(found, docs.columns, text=F.when(F.size("_spans") > 0, marked).otherwise(F.col("text")))


def _listed(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"], x["end"])), ","
    )


def op10_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = detect(docs, fit(docs))
    of_kind = lambda i: F.filter("base", lambda x: x["kind"] == i)
    counts = [F.size(of_kind(i)).cast("long").alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))
