"""Personal data: proposed spans, boosted trees, calibrated thresholds, in SQL functions only.

Generators of high recall propose spans in every text: the four base formats, and wide ones
(spelled-out addresses, longer or unchecked numbers, numbers without a country code).
Base spans that pass their check always stay. Every other proposal is judged by gradient
boosted trees on its format (length, digits, groups) and context (characters around it,
words before it). The trees learn from a bounded sample of documents, where the checks
label the base formats: a match that passes is personal, one that fails is not. What a family's
check looks at is hidden from its trees (``DECIDES``), so that they learn from the context and
from the rest of the format, which proposals without a check share. Per family of formats, the
threshold is the lowest score above which the held-out half of all documents is right often
enough; a family's few labels count together with ``PRIOR`` ones at the rate of all families.

Proposals that overlap are picked best first: base spans, then by score (of equals the one that
starts first, then by kind), each unless it overlaps one that was picked. Sorted by start they
fall into clusters that touch no other, and only within a cluster proposals are compared. So a
text with very many proposals takes about linear time unless they overlap each other in long
chains.

The trees become one SQL expression, evaluated where the text is; nothing is shuffled.

Positions come from the gaps between matches, added up block by block, so that a text with
very many matches stays close to linear.

Defined cases: a null or empty text has no spans; without both kinds of labels in the
sample only base spans are found; texts of any length are read whole; repeated rows are rows
of their own; an empty table gives an empty result; input columns named like result columns
are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanfold.llm.common import text_or_empty

BLOCK = 64
SAMPLE_DOCS = 20_000
PRECISION = 0.95
BINS = 50
PRIOR = 4
SWEEP = 256

# The base formats. A match begins where its run of characters does, or where
# the match before ended; that is what a search from the left finds, without trying every
# place within a run.
_LOCAL, _DOMAIN = "A-Za-z0-9._%+-", "A-Za-z0-9-"
_RUN = r"(?:(?<![{0}])|\G)"
BASE = {
    "email": _RUN.format(_LOCAL) + rf"[{_LOCAL}]++@[{_DOMAIN}]++(?:\.[{_DOMAIN}]++)++",
    "ip": _RUN.format("0-9") + r"[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Wide formats, and the family whose labels judge them.
WIDE = {
    "email_like": (
        "email",
        rf"(?<![{_LOCAL}])[{_LOCAL}]++ ?[\[(] ?(?i:at) ?[\])] ?[{_DOMAIN}]++(?:(?:\.| ?[\[(] ?(?i:dot) ?[\])] ?)[{_DOMAIN}]++)++",
    ),
    "phone_like": ("phone", r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
}
# What must occur in a text for a format to be searched at all.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}
_HINTS = {
    "email": "mail|contact|write|reply",
    "ip": r"\bip\b|host|server|address|login",
    "card": "card|visa|master|credit|account|payment|pay",
    "phone": "phone|call|tel|mobile|cell|fax|dial",
}
FAMILIES = tuple(BASE)
FEATURES = (
    "family", "length", "digits", "signs", "groups", "kinds", "before", "after", "hint", "zero",
)
# What the check of a family decides by, or what shows it.
DECIDES = {
    "email": (), "ip": ("length", "digits"), "card": ("length", "digits"),
    "phone": ("length", "digits", "kinds", "groups", "signs"),
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _placed(text: Column, pattern: str, needs: str | None) -> Column:
    """Matches with start, end and what stands before and after."""
    regex = F.lit(pattern)

    def within(block: Column, offset: Column) -> Column:
        def one(match: Column, at: Column) -> Column:
            before = _sum(F.transform(F.slice(block, 1, at), lambda m: m["gap"] + m["size"]))
            start = offset + before + match["gap"]
            return F.struct(
                start.alias("start"), (start + match["size"]).alias("end"), match["value"].alias("value"),
                match["left"].alias("left"), match["right"].alias("right"),
            )

        return F.transform(block, one)

    def place(found: Column) -> Column:
        values, gaps = found["values"], found["gaps"]
        matches = F.zip_with(
            values, F.zip_with(
                F.slice(gaps, 1, F.size(values)), F.slice(gaps, 2, F.size(values)),
                lambda left, right: F.struct(left.alias("left"), right.alias("right")),
            ),
            lambda value, gap: F.struct(
                F.length(gap["left"]).cast("bigint").alias("gap"), F.length(value).cast("bigint").alias("size"),
                value.alias("value"), F.right(gap["left"], F.lit(24)).alias("left"),
                F.left(gap["right"], F.lit(8)).alias("right"),
            ),
        )
        last = F.floor((F.size(values) - 1) / BLOCK).cast("int")

        def blocks(all_matches: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(0), last), lambda b: F.slice(all_matches, b * BLOCK + 1, BLOCK)
            )

        def joined(cut: Column) -> Column:
            totals = F.transform(cut, lambda b: _sum(F.transform(b, lambda m: m["gap"] + m["size"])))
            return _let(
                totals,
                lambda t: F.flatten(
                    F.transform(cut, lambda b, n: within(b, _sum(F.slice(t, 1, n))))
                ),
            )

        return F.when(F.size(values) == 0, nothing).otherwise(
            _let(matches, lambda m: _let(blocks(m), joined))
        )

    nothing = F.array().cast(
        "array<struct<start:bigint,end:bigint,value:string,left:string,right:string>>"
    )
    found = F.struct(
        F.regexp_extract_all(text, regex, F.lit(0)).alias("values"), F.split(text, pattern, -1).alias("gaps")
    )
    placed = _let(found, place)
    wanted = F.contains(text, F.lit(needs)) if needs else text.rlike("[0-9]|[\\[(] ?(?i:at) ?[\\])]")
    return F.when(wanted, placed).otherwise(nothing)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _passes(family: str, value: Column) -> Column:
    """The check of a base format."""
    if family == "ip":
        def small(part: Column) -> Column:
            return _let(
                F.regexp_replace(part, "^0+", ""),
                lambda p: F.when(F.length(p) > 3, False).when(p == "", True).otherwise(p.cast("int") <= 255),
            )

        return F.forall(F.split(value, r"\."), small)
    if family == "card":
        return _let(
            _digits(value), lambda d: F.length(d).between(16, 19) & F.call_function("luhn_check", d)
        )
    if family == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _character(value: Column) -> Column:
    """0 none or blank, 1 letter, 2 digit, 3 other."""
    return F.when((F.length(value) == 0) | value.rlike(r"\s"), 0.0).when(
        value.rlike(r"\p{L}"), 1.0
    ).when(value.rlike("[0-9]"), 2.0).otherwise(3.0)


def _features(family: str, c: Column) -> Column:
    value = c["value"]
    number = [
        F.lit(float(FAMILIES.index(family))),
        F.length(value),
        F.length(_digits(value)),
        F.length(F.regexp_replace(value, "[A-Za-z0-9]", "")),
        F.size(F.split(value, "[^A-Za-z0-9]+")),
        F.size(F.array_distinct(F.split(_digits(value), ""))),
        _character(F.right(c["left"], F.lit(1))),
        _character(F.left(c["right"], F.lit(1))),
        F.when(F.lower(c["left"]).rlike(_HINTS[family]), 1.0).otherwise(0.0),
        F.when(value.startswith("0"), 1.0).otherwise(0.0),
    ]
    hidden = F.lit(-1.0)
    return F.struct(
        *[
            (hidden if name in DECIDES[family] else n.cast("double")).alias(name)
            for n, name in zip(number, FEATURES, strict=True)
        ]
    )


def _candidates(text: Column) -> Column:
    """All proposals: kind, family, base (passes the check of a base format), labelled,
    start, end, features."""

    def described(kind: str, family: str, pattern: str, labelled: bool) -> Column:
        def one(c: Column) -> Column:
            checked = _passes(family, c["value"]) if labelled else F.lit(False)
            return F.struct(
                F.lit(kind).alias("kind"), F.lit(family).alias("family"), checked.alias("base"),
                F.lit(labelled).alias("labelled"), c["start"].alias("start"), c["end"].alias("end"),
                _features(family, c).alias("features"),
            )

        placed = _placed(text, pattern, _NEEDS.get(kind))
        if kind == "card":  # what is shorter or longer is no card in any reading
            placed = F.filter(placed, lambda c: F.length(_digits(c["value"])).between(12, 19))
        return F.transform(placed, one)

    found = [described(k, k, p, True) for k, p in BASE.items()]
    found += [described(k, f, p, False) for k, (f, p) in WIDE.items()]
    return F.concat(*found)


@dataclass(frozen=True)
class Judge:
    """Boosted trees as weighted expressions of a candidate's features, and thresholds."""

    model: GBTClassificationModel | None
    thresholds: dict[str, float]

    def score(self, features: Column) -> Column:
        if self.model is None:
            return F.lit(0.0)
        total = F.lit(0.0)
        for tree, weight in zip(self.model.trees, self.model.treeWeights, strict=True):
            total = total + _tree(tree._call_java("rootNode"), features) * float(weight)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(total * -2.0))

    def accepts(self, family: Column, score: Column) -> Column:
        accepted = F.lit(False)
        for name, threshold in self.thresholds.items():
            accepted = F.when(family == name, score >= threshold).otherwise(accepted)
        return accepted


def _tree(node, features: Column) -> Column:
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    goes_left = features[FEATURES[split.featureIndex()]] <= float(split.threshold())
    return F.when(goes_left, _tree(node.leftChild(), features)).otherwise(
        _tree(node.rightChild(), features)
    )


def fit(
    docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS, precision: float = PRECISION
) -> Judge:
    """Learn the trees from half of about ``sample_docs`` documents, picked by a hash of the
    text, and the thresholds from half of all documents."""
    rows = docs.select(text_or_empty(text).alias("_text"))
    share = min(1.0, sample_docs / max(1, rows.count()))
    held_out = F.pmod(F.xxhash64("_text", F.lit(1)), F.lit(2)) == 0
    sample = rows.where((F.pmod(F.xxhash64("_text"), F.lit(1_000_000)) < int(share * 1_000_000)) & ~held_out)
    sample = sample.dropDuplicates(["_text"])  # copies are no further evidence
    labelled = sample.select(F.explode(_candidates(F.col("_text"))).alias("c")).where("c.labelled").select(
        "c.family", F.col("c.base").cast("double").alias("label"), "c.features.*", F.col("c.family").alias("of"),
    )
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(
        labelled.drop("family").withColumn("family", _family_number(F.col("of")))
    ).select("label", "vector").cache()
    try:
        seen = {r["label"] for r in vectors.select("label").distinct().collect()}
        if seen != {0.0, 1.0}:
            return Judge(None, {})
        model = GBTClassifier(
            featuresCol="vector", labelCol="label", maxIter=10, maxDepth=3, stepSize=0.3, seed=1
        ).fit(vectors)
        return Judge(model, _calibrated(model, rows.where(held_out), precision))
    finally:
        vectors.unpersist()


def _family_number(family: Column) -> Column:
    number = F.lit(0.0)
    for n, name in enumerate(FAMILIES):
        number = F.when(family == name, float(n)).otherwise(number)
    return number


def _calibrated(model: GBTClassificationModel, rows: DataFrame, precision: float) -> dict[str, float]:
    """Thresholds from the labelled candidates of all ``rows``."""
    score = Judge(model, {}).score(F.col("c.features"))
    # one row per candidate of a text, so that copies are no further evidence
    scored = rows.select(
        F.xxhash64("_text").alias("text"),
        F.explode(F.filter(_candidates(F.col("_text")), lambda c: c["labelled"])).alias("c"),
    ).select(
        "text", F.col("c.family").alias("of"), F.col("c.start").alias("start"),
        F.col("c.base").cast("double").alias("label"), F.floor(score * BINS).alias("bin"),
    ).dropDuplicates(["text", "of", "start"])
    # families x BINS rows
    bins = scored.groupBy("of", "bin").agg(F.sum("label").alias("right"), F.count(F.lit(1)).alias("n")).collect()
    return thresholds([(b["of"], b["bin"], b["right"], b["n"]) for b in bins], precision)


def thresholds(bins: list[tuple[str, int, float, int]], precision: float) -> dict[str, float]:
    """Per family the lowest score from which on enough is right, of (family, bin, right, all)."""
    found = {}
    for family in FAMILIES:
        right = n = all_right = all_n = 0.0
        for score in sorted({b for _, b, _, _ in bins}, reverse=True):
            for of, at, good, count in bins:
                if at == score:
                    all_right, all_n = all_right + good, all_n + count
                    if of == family:
                        right, n = right + good, n + count
            rate = (all_right + 1) / (all_n + 2)
            if (right + PRIOR * rate) / (n + PRIOR) >= precision:
                found[family] = score / BINS
    return found


PICKED = "struct<start:bigint,end:bigint,score:double,kind:string,base:boolean>"


def _clusters(sorted_spans: Column) -> Column:
    """Spans in order of their starts, cut where none reaches over. Block by block, so that no
    long array is copied for each span."""
    nothing = F.array().cast(f"array<{PICKED}>")
    none = F.array().cast(f"array<array<{PICKED}>>")

    def state(open_: Column, reach: Column, closed: Column) -> Column:
        return F.struct(open_.alias("open"), reach.alias("reach"), closed.alias("closed"))

    def one(a: Column, s: Column) -> Column:
        return F.when(
            s["start"] < a["reach"],
            state(F.concat(a["open"], F.array(s)), F.greatest(a["reach"], s["end"]), a["closed"]),
        ).otherwise(
            state(
                F.array(s), s["end"],
                F.when(F.size(a["open"]) > 0, F.concat(a["closed"], F.array(a["open"]))).otherwise(a["closed"]),
            )
        )

    def block(a: Column, spans: Column) -> Column:
        inner = F.aggregate(spans, state(a["open"], a["reach"], none), one)
        return _let(
            inner,
            lambda i: F.struct(
                i["open"].alias("open"), i["reach"].alias("reach"),
                F.concat(a["blocks"], F.array(i["closed"])).alias("blocks"),
            ),
        )

    last = F.floor((F.size(sorted_spans) - 1) / SWEEP).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(sorted_spans, b * SWEEP + 1, SWEEP))
    begin = F.struct(
        nothing.alias("open"), F.lit(-1).cast("bigint").alias("reach"),
        F.array().cast(f"array<array<array<{PICKED}>>>").alias("blocks"),
    )
    whole = F.aggregate(
        blocks, begin, block, lambda a: F.concat(F.flatten(a["blocks"]), F.array(a["open"]))
    )
    return F.when(F.size(sorted_spans) == 0, none).otherwise(whole)


def _best_first(cluster: Column) -> Column:
    """Of spans that may overlap, each unless it overlaps a better one that stays."""

    def overlap(a: Column, b: Column) -> Column:
        return (a["start"] < b["end"]) & (b["start"] < a["end"])

    def order(s: Column) -> Column:
        return F.struct(
            (~s["base"]).alias("rank"), (-s["score"]).alias("score"), s["start"].alias("start"),
            s["kind"].alias("kind"), s.alias("span"),
        )

    def take(kept: Column, o: Column) -> Column:
        free = o["span"]["base"] | ~F.exists(kept, lambda k: overlap(k, o["span"]))
        return F.when(free, F.concat(kept, F.array(o["span"]))).otherwise(kept)

    picked = F.aggregate(
        F.array_sort(F.transform(cluster, order)), F.array().cast(f"array<{PICKED}>"), take
    )
    return F.when(F.size(cluster) == 1, cluster).otherwise(picked)


def pick(spans: Column) -> Column:
    """What stays of proposals (start, end, score, kind, base)."""
    return _let(
        F.array_sort(spans), lambda s: F.flatten(F.transform(_clusters(s), _best_first))
    )


def find(docs: DataFrame, judge: Judge, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans`` (kind, start, end; by kind, then start)."""
    def shown(c: Column) -> Column:
        # a checked format that fails its check but is accepted goes by its wide name
        named = F.when(c["base"] | ~c["labelled"], c["kind"]).otherwise(F.concat(c["kind"], F.lit("_like")))
        return F.struct(named.alias("kind"), c["start"].alias("start"), c["end"].alias("end"))

    def of_kind(spans: Column, kind: str) -> Column:
        return F.filter(spans, lambda s: s["kind"] == kind)

    def judged(found: Column) -> Column:
        def one(c: Column) -> Column:
            score = F.when(c["base"], 2.0).otherwise(judge.score(c["features"]))
            return F.struct(shown(c).alias("s"), score.alias("score"), c["base"].alias("base"), c["family"].alias("family"))

        accepted = F.filter(
            F.transform(found, one), lambda j: j["base"] | judge.accepts(j["family"], j["score"])
        )
        return F.transform(
            accepted,
            lambda j: F.struct(
                j["s"]["start"].alias("start"), j["s"]["end"].alias("end"), j["score"].alias("score"),
                j["s"]["kind"].alias("kind"), j["base"].alias("base"),
            ),
        )

    def picked(found: Column) -> Column:
        def span(s: Column) -> Column:
            return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))

        kept = F.transform(F.filter(found, lambda c: c["base"]), shown)

        def listed(all_: Column) -> Column:
            more = F.transform(F.filter(all_, lambda s: ~s["base"]), span)
            by_kind = F.flatten(F.array(*[F.array_sort(of_kind(more, f"{f}_like")) for f in FAMILIES]))
            return F.struct(kept.alias("base"), F.concat(kept, by_kind).alias("all"))

        if not judge.thresholds:
            return F.struct(kept.alias("base"), kept.alias("all"))
        return _let(pick(judged(found)), listed)

    found = _let(_candidates(text_or_empty(text)), picked)
    kept = [c for c in docs.columns if c not in ("base_spans", "spans", "_found")]
    rows = docs.withColumn("_found", found)
    return rows.select(*kept, F.col("_found.base").alias("base_spans"), F.col("_found.all").alias("spans"))
