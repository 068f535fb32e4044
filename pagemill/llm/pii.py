"""Personal data in texts: rules whose finds always stay, and boosted trees that pick
further spans among the overlapping candidates of looser generators.

No span is labelled. The trees learn from finds and from disguises of them, which no rule
takes: an address with "(at)", a number without its plus, a card joined by full stops. The
negative examples are proposals that the rule's test refuses in any disguise, and finds spoilt
to be part of a longer word. What passes the test in disguise is neither: the trees decide.

All of it is column functions and Spark's own gradient-boosted trees. A rule or
generator is one regular expression without nested repetition, so texts of any length
pass; the gaps between its matches and their lengths give the positions.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from pagemill.llm.chars import text_or_empty
from pagemill.sources.scratch import materialize

KINDS = ("email", "ip", "card", "phone")
TRAIN_ROWS = 20_000
TREES, DEPTH = 12, 3
PRECISION = 0.95
BINS = 50
SEED = 10
# A joint is a separator between two characters of the right kind; it is replaced by
# this character, which texts do not hold once OTHER_MARK stands in for it.
MARK, OTHER_MARK = "\ue000", "\ue001"
CONTEXT = 24

_LOCAL = rf"[A-Za-z0-9._%+{MARK}-]"
_HOST = "[A-Za-z0-9-]"
_CUES = {
    "email": "mail|contact|write|@",
    "ip": "host|server|address|addr|ip",
    "card": "card|visa|pay|credit|account",
    "phone": "phone|tel|call|mobile|fax|dial",
}


def _joints(text: Column, before: str, joint: str, after: str) -> Column:
    clean = F.translate(text, MARK, OTHER_MARK)
    return F.regexp_replace(clean, rf"(?<={before}){joint}(?={after})", MARK)


@dataclass(frozen=True)
class Rule:
    """Where a kind of span is looked for. ``base`` rules count, others only propose.
    ``hint`` is a pattern without which the text cannot match."""

    kind: str
    base: bool
    hint: str
    prepare: Callable[[Column], Column]
    pattern: str


RULES = (
    Rule("email", True, "@", lambda t: _joints(t, _HOST, r"\.", _HOST),
         rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++{MARK}[A-Za-z0-9{MARK}-]*+"),
    Rule("ip", True, r"[0-9]\.[0-9]", lambda t: t, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    Rule("card", True, "[0-9][ -]?[0-9]", lambda t: _joints(t, "[0-9]", "[ -]", "[0-9]"), rf"[0-9{MARK}]{{13,}}+"),
    Rule("phone", True, r"\+[0-9]", lambda t: t, r"\+[0-9][ ().0-9-]+[0-9]"),
    Rule("email", False, r"@|\([aA][tT]\)|\[[aA][tT]\]", lambda t: _joints(t, _HOST, r"\.", _HOST),
         rf"(?<!{_LOCAL}){_LOCAL}++ ?(?:@|\([aA][tT]\)|\[[aA][tT]\]) ?{_HOST}++[A-Za-z0-9{MARK}-]*+"),
    Rule("card", False, "[0-9][ .-]?[0-9]", lambda t: _joints(t, "[0-9]", "[ .-]", "[0-9]"), rf"[0-9{MARK}]{{12,23}}+"),
    Rule("phone", False, "[(0-9][ ().0-9-]{7}", lambda t: t, r"(?<![0-9])[(0-9][ ().0-9-]{7,20}[0-9]"),
    Rule("ip", False, r"[0-9]\.[0-9]", lambda t: t, r"(?<![0-9.])[0-9]{1,3}[.:][0-9]{1,3}[.:][0-9]{1,3}[.:][0-9]{1,3}"),
)


def _proposals(text: Column) -> Column:
    """(rule, gap, span, before, after) of the matches of every rule in text order: the
    characters since the match before, the match, and the characters around it."""

    def numbered(number: int) -> Callable[[Column, Column], Column]:
        return lambda p, i: F.struct(
            F.lit(number).alias("rule"),
            i.alias("i"),
            F.length(p["gap"]).alias("gap"),
            p["span"].alias("span"),
            F.lower(F.right(p["gap"], F.lit(CONTEXT))).alias("before"),
        )

    lists = []
    for number, rule in enumerate(RULES):
        prepared = rule.prepare(text)
        matches = F.regexp_extract_all(prepared, F.lit(rule.pattern), F.lit(0))
        pairs = F.arrays_zip(F.split(prepared, rule.pattern).alias("gap"), matches.alias("span"))
        found = F.transform(F.filter(pairs, lambda p: p["span"].isNotNull()), numbered(number))
        none = F.array().cast("array<struct<rule:int,i:int,gap:int,span:string,before:string>>")
        lists.append(F.when(text.rlike(rule.hint), found).otherwise(none))
    return F.concat(*lists)


def _octets_fit(span: Column) -> Column:
    parts = F.transform(F.split(span, r"[.:]"), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    from_end = F.reverse(F.split(digits, "(?<=.)(?=.)"))

    def value(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.transform(from_end, value), F.lit(0), lambda a, v: a + v)
    return total % 10 == 0


def _passes(kind: Column, span: Column) -> Column:
    digits = F.regexp_replace(span, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == "ip", _octets_fit(span))
        .when(kind == "card", F.when(n.between(13, 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(True)
    )


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, _key, kind, start, end, base, span, before, touches) of every proposed
    span; ``base`` marks the finds of the rules and ``touches`` other spans that overlap
    one. Rows equal in id and text give theirs once."""
    text = text_or_empty(F.col("text"))
    rows = docs.select("doc_id", text.alias("text")).select(
        "doc_id", F.xxhash64("text").alias("_key"), F.inline(_proposals(F.col("text")))
    )
    own = Window.partitionBy("doc_id", "_key", "rule").orderBy("i")
    stop = F.sum(F.col("gap") + F.length("span")).over(own)
    kinds = F.array(*(F.lit(r.kind) for r in RULES))
    is_base = F.array(*(F.lit(r.base) for r in RULES))
    placed = rows.repartition("doc_id", "_key").dropDuplicates(["doc_id", "_key", "rule", "i"]).withColumns({
        "end": stop,
        "start": stop - F.length("span"),
        "kind": F.get(kinds, F.col("rule")),
        "_rule": F.get(is_base, F.col("rule")),
    })
    found = F.max(F.col("_rule") & _passes(F.col("kind"), F.col("span"))).alias("base")
    spans = placed.groupBy("doc_id", "_key", "kind", "start", "end").agg(
        found, F.min("span").alias("span"), F.min("before").alias("before")
    )
    by_place = Window.partitionBy("doc_id", "_key").orderBy("start")
    reached = F.max(F.when(F.col("base"), F.col("end"))).over(by_place)
    following = by_place.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(following)
    near = (F.coalesce(reached, F.lit(0)) > F.col("start")) | (F.coalesce(ahead, F.col("end")) < F.col("end"))
    return spans.withColumn("touches", near & ~F.col("base"))


FEATURES = ("length", "digits", "letters", "marks", "groups", "longest", "distinct", "cue", "word_before", "space_before", "kind_no")


def with_features(spans: DataFrame) -> DataFrame:
    """Format and context of spans, as numbers. What the rules test in the end, a plus
    sign, check digits or number ranges, is left out."""
    span, before = F.col("span"), F.col("before")
    digits = F.regexp_replace(span, "[^0-9]", "")
    groups = F.regexp_extract_all(span, F.lit("[0-9]+"), F.lit(0))
    cue = F.lit(False)
    for kind, words in _CUES.items():
        cue = cue | ((F.col("kind") == kind) & before.rlike(words))
    number = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    values = {
        "length": F.length(span),
        "digits": F.length(digits),
        "letters": F.length(F.regexp_replace(span, "[^A-Za-z]", "")),
        "marks": F.length(F.regexp_replace(span, "[A-Za-z0-9]", "")),
        "groups": F.size(groups),
        "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "distinct": F.size(F.array_distinct(F.split(span, ""))),
        "cue": cue,
        "word_before": before.rlike("[a-z0-9]$"),
        "space_before": before.rlike(r"\s$"),
        "kind_no": number,
    }
    return spans.withColumns({name: values[name].cast("double") for name in FEATURES})


def _unit(*cols: str) -> Column:
    """A number in [0, 1) that depends on the columns only."""
    return F.pmod(F.xxhash64(F.lit(SEED), *(F.col(c) for c in cols)), F.lit(1 << 20)) / float(1 << 20)


def passes_disguised(kind: Column, span: Column) -> Column:
    """Whether a span would pass its rule's test if it were written as the rule wants it."""
    host = F.regexp_extract(span, r"(?:@|\)|\])(.*)$", 1)
    return F.when(kind == "email", host.rlike(rf"[.{MARK}]")).otherwise(_passes(kind, span))


def disguised(kind: Column, span: Column, form: Column) -> Column:
    """A find written so that no rule takes it, one of four ways by the number ``form``."""
    at = F.element_at(F.array(*(F.lit(a) for a in ("(at)", "[at]", " (at) ", " [at] "))), form + 1)
    digits = F.regexp_replace(span, "[^0-9]", "")
    return (
        F.when(kind == "email", F.replace(span, F.lit("@"), at))
        .when(kind == "phone", F.replace(span, F.lit("+"), F.when(form < 2, "").otherwise("00")))
        .when(kind == "card", F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", "$1."))
        .otherwise(F.translate(span, ".", ":"))
    )


def spoilt(kind: Column, span: Column) -> Column:
    """What a find would be as part of a longer word: an address without a full stop in its
    host, the digits of a number run together, an IP address as it is."""
    digits = F.regexp_replace(span, "[^0-9]", "")
    return F.when(kind == "email", F.regexp_extract(span, "^[^@]*@[A-Za-z0-9-]*", 0)).when(kind == "ip", span).otherwise(digits)


def examples(spans: DataFrame) -> DataFrame:
    """(the columns of ``spans``, label, part) of what the trees learn from and decide on: part 0 is
    the span itself, label null where they decide; 1 a find in disguise, 2 a find spoilt."""
    kind, span, base = F.col("kind"), F.col("span"), F.col("base")

    def row(part: int, label: Column, text: Column, before: Column) -> Column:
        return F.struct(F.lit(part).alias("part"), label.alias("label"), text.alias("s"), before.alias("b"))

    own = F.when(base, 1.0).when(~passes_disguised(kind, span), 0.0)
    first = row(0, own, span, F.col("before"))
    form = (_unit("doc_id", "_key", "end") * 4).cast("int")
    more = (
        first,
        row(1, F.lit(1.0), disguised(kind, span, form), F.col("before")),
        row(2, F.lit(0.0), spoilt(kind, span), F.concat(F.col("before"), F.lit("v"))),
    )
    rows = spans.select("*", F.explode(F.when(base, F.array(*more)).otherwise(F.array(first))).alias("e"))
    return rows.withColumns({"span": F.col("e.s"), "before": F.col("e.b"), "label": F.col("e.label"), "part": F.col("e.part")}).drop("e")


def selected(spans: DataFrame, rows: int = TRAIN_ROWS, precision: float = PRECISION) -> DataFrame:
    """The proposals that are no finds of a rule, touch none, and score as high as finds do.

    Trees learn to tell finds and their disguises from other proposals and spoilt finds on at
    most about ``rows`` examples, an equal part for both labels of every kind, chosen by hash; a
    rare kind is taken whole. Thresholds come from the scores of all labelled examples, nearly all
    of them unseen in a large corpus: for each kind the lowest score from which on the share of
    positive ones is at least ``precision``. A kind without finds adds nothing, and without
    any finds nothing is selected. Proposals that the test refuses in any disguise are negative
    examples; their threshold comes from proposals alone, without disguises, so they are selected
    only if what looks like them nearly always passes.
    """
    spans = spans.where("NOT touches")
    shown = examples(spans)
    labelled = shown.where("label IS NOT NULL")
    totals = {(r.kind, r.label): r.n for r in labelled.groupBy("kind", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if {label for _, label in totals} != {1.0, 0.0}:
        return spans.limit(0)
    part = rows / (2 * len(KINDS))
    share = F.lit(1.0)
    for (kind, label), n in totals.items():
        share = F.when((F.col("kind") == kind) & (F.col("label") == label), min(1.0, part / n)).otherwise(share)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    sample = labelled.where(_unit("doc_id", "_key", "kind", "start", "end", "part") < share)
    training = materialize(vectors.transform(with_features(sample)).select("features", "label"))
    if training.select("label").distinct().count() < 2:
        return spans.limit(0)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label")
    model = trees.fit(training)
    score = F.get(vector_to_array("probability"), F.lit(1))
    scored = model.transform(vectors.transform(with_features(shown)))
    scored = materialize(scored.select(*shown.columns, F.floor(score * BINS).alias("bin")))
    hits = F.sum(F.col("label").cast("int")).alias("hits")
    own = (F.col("part") == 0).alias("own")
    bins = scored.where("label IS NOT NULL").groupBy("kind", own, "bin").agg(F.count(F.lit(1)).alias("n"), hits).collect()
    undecided = _limit(bins, precision)
    refused = _limit([r for r in bins if r.own], precision)
    limit = F.when(F.col("label").isNull(), undecided).otherwise(refused)
    return scored.where((F.col("part") == 0) & ~F.col("base") & (F.col("bin") >= limit)).select(*spans.columns)


def _limit(bins: Sequence[Row], precision: float) -> Column:
    """For each kind the lowest bin from which on the share of hits is at least ``precision``."""
    limit = F.lit(BINS + 1)
    for kind in KINDS:
        n = hits = 0
        for at in sorted({r.bin for r in bins if r.kind == kind}, reverse=True):
            here = [r for r in bins if r.kind == kind and r.bin == at]
            n, hits = n + sum(r.n for r in here), hits + sum(r.hits for r in here)
            if hits >= precision * n:
                limit = F.when(F.col("kind") == kind, at).otherwise(limit)
    return limit


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<kind_no, start, end, base>>) of every row of (doc_id,
    text), ordered by kind and place, in code points, the end exclusive.

    Finds of the rules all stay. A further span is added where the trees select it and
    it overlaps no find and no longer span that is added. A null or empty text has no
    spans; rows equal in id and text get the same, null ids too; an empty table gives
    no rows.
    """
    spans = materialize(candidates(docs))
    number = (F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind")) - 1).cast("int")
    span = F.struct(number.alias("kind_no"), "start", "end", "base")
    # A struct that sorts by length, longest first, for the choice among added spans.
    more = F.struct((F.col("start") - F.col("end")).alias("_order"), span.alias("s"))
    kept = spans.where("base").select("doc_id", "_key", span.alias("kept"), F.lit(None).cast("struct<_order:int,s:struct<kind_no:int,start:bigint,end:bigint,base:boolean>>").alias("more"))
    added = selected(spans).select("doc_id", "_key", F.lit(None).cast("struct<kind_no:int,start:bigint,end:bigint,base:boolean>").alias("kept"), more.alias("more"))
    lists = kept.unionByName(added, allowMissingColumns=False).groupBy(F.col("doc_id").alias("_id"), F.col("_key").alias("_k")).agg(
        F.collect_list("kept").alias("kept"), F.array_sort(F.collect_set("more")).alias("more")
    )

    def take(found: Column, m: Column) -> Column:
        free = ~F.exists(found, lambda f: (f["start"] < m["s"]["end"]) & (m["s"]["start"] < f["end"]))
        return F.when(free, F.concat(found, F.array(m["s"]))).otherwise(found)

    lists = lists.select("_id", "_k", F.array_sort(F.aggregate("more", F.col("kept"), take)).alias("spans"))
    rows = docs.select("doc_id", F.xxhash64(text_or_empty(F.col("text"))).alias("_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k"))
    none = F.array().cast("array<struct<kind_no:int,start:bigint,end:bigint,base:boolean>>")
    return rows.join(lists, same, "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and joined spans of each document."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind_no"]), s["start"], s["end"])), ",")


    def number(k: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind_no"] == k)).cast("bigint")

    counts = [number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
