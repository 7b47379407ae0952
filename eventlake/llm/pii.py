"""Personal data: fixed patterns, and contexts bootstrapped from what they find.

Everything runs as DataFrame functions.  The base patterns give the seed entities.  Other
strings that begin a word and have some kind's loose ``SHAPE`` are candidates, where they meet no
base span.  The words before an entity or candidate are its lexical patterns (one and two
words).  Patterns and strings form a graph whose edges count occurrences.  Rounds alternate: a pattern's score for a kind is the mean score of its
instances, shrunk by ``PRIOR`` and void below ``MIN_SEEDS`` distinct scored instances; an instance's
score is that of its best pattern, seeds keep 1.  Unseeded instances of a kind's own shape
that reach ``THRESHOLD`` are discovered, and all their occurrences become further spans.

Spans are code points, end exclusive; a base span always stays and a further span never
overlaps one.  Edge cases: a null or empty text has no spans; repeated rows are scanned each;
without seeds nothing is added; ids play no part, so they may be null or repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventlake.llm.common import cut, table

KINDS = ("email", "ip", "card", "phone")
ROUNDS, PRIOR, MIN_SEEDS, THRESHOLD = 3, 2.0, 3, 0.8
#: Fixed values, written so that Java neither backtracks nor recurses: a run may start only where no
#: run is open or where the last match ended, and repeats are possessive.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without these has no match of the kind.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
#: Hint and pattern of candidate strings: numbers in groups, and words with an at sign.
LOOSE = (("[0-9]", r"(?<![^\x20\x09-\x0D(\[<])[+(]?[0-9](?:\x20?[0-9A-Fa-f()./:-]*[0-9])*+"),
         (r"@|\(at\)|\[at\]", r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D@\[(]++(?:@|\(at\)|\[at\])[^\x20\x09-\x0D@]*[0-9A-Za-z]"))
#: Shapes an unseen identifier of a kind must have.
SHAPE = {
    "email": r"^[^@]+(?:@|\(at\)|\[at\])[^@]+$",
    "ip": r"^[0-9A-Fa-f]{1,4}(?:[.:][0-9A-Fa-f]{0,4}){3,7}$",
    "card": r"^[0-9][0-9 .-]{11,22}[0-9]$",
    "phone": r"^[(+]?[0-9][0-9 ()./-]{6,18}[0-9]$",
}


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, pattern: str, keep) -> Column:
    """array<struct<start, end, found>> of the pattern's leftmost non-overlapping matches that
    satisfy ``keep(found)``; positions add up the lengths of matches and of what lies between."""
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")

    def step(acc, p):
        def one(start):
            end = start + F.length(p["found"])
            own = F.array(F.struct(start.alias("start"), end.alias("end"), p["found"].alias("found")))
            return F.struct(F.when(keep(p["found"]), F.concat(acc["out"], own)).otherwise(acc["out"]).alias("out"), end.alias("at"))
        return bind(acc["at"] + F.length(p["between"]), one)

    def place(x):
        pairs = F.zip_with(x["found"], F.slice(x["between"], 1, F.size(x["found"])), lambda f, b: F.struct(f.alias("found"), b.alias("between")))
        return F.when(F.size(x["found"]) > 0, F.aggregate(pairs, F.struct(none.alias("out"), F.lit(0).alias("at")), step)["out"]).otherwise(none)

    return bind(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between")), place)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    at = lambda i: F.substring(F.reverse(digits), i + 1, 1).cast("int")
    doubled = lambda v: F.when(v > 4, 2 * v - 9).otherwise(2 * v)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0),
                       lambda acc, i: acc + F.when(i % 2 == 1, doubled(at(i))).otherwise(at(i))) % 10 == 0


def valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return found.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return bind(digits, lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))
    return F.length(digits).between(9, 15) if kind == "phone" else F.lit(True)


SPANS = "array<struct<kind_no:int,start:int,end:int,found:string>>"


def base_spans(text: Column) -> Column:
    """array<struct<kind_no, start, end, found>> by kind as listed, then start."""
    def part(no: int, kind: str) -> Column:
        spans = F.transform(matches(text, BASE[kind], lambda found: valid(kind, found)), lambda m: F.struct(
            F.lit(no).alias("kind_no"), m["start"].alias("start"), m["end"].alias("end"), m["found"].alias("found")))
        return F.when(text.rlike(HINT[kind]), spans).otherwise(F.array().cast(SPANS))

    return F.concat(*(part(no, kind) for no, kind in enumerate(KINDS)))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined in the array's order."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind_no"] + 1), s["start"], s["end"])), ",")


def candidates(text: Column, base: Column) -> Column:
    """Spans (kind_no null) of strings that have a kind's loose shape and meet no base span."""
    shaped = lambda found: F.coalesce(*(F.when(found.rlike(SHAPE[k]), F.lit(True)) for k in KINDS), F.lit(False))

    def free(m):
        return ~F.exists(base, lambda s: (s["start"] < m["end"]) & (m["start"] < s["end"]))

    every = F.concat(*(F.when(text.rlike(hint), matches(text, pattern, shaped)).otherwise(F.array().cast("array<struct<start:int,end:int,found:string>>"))
                       for hint, pattern in LOOSE))
    return F.transform(F.filter(every, free), lambda m: F.struct(F.lit(None).cast("int").alias("kind_no"), m["start"].alias("start"),
                                                                 m["end"].alias("end"), m["found"].alias("found")))


def with_context(text: Column, spans: Column) -> Column:
    """The spans with ``l1`` and ``l2``: the last one and two words before, lower-cased, digits as 0."""
    def describe(s):
        left = F.lower(F.regexp_replace(F.substring(text, F.greatest(F.lit(1), s["start"] - 79), F.least(F.lit(80), s["start"])), "[0-9]", "0"))
        return bind(left, lambda x: F.struct(
            s["kind_no"].alias("kind_no"), s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("instance"),
            F.regexp_extract(x, r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", 1).alias("l1"),
            F.regexp_extract(x, r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]+[^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", 1).alias("l2")))

    return F.transform(spans, describe)


def bootstrap(spark: SparkSession, found: DataFrame, rounds: int, threshold: float) -> DataFrame:
    """(instance, kind_no) of discovered identifiers, from ``found(instance, kind_no, l1, l2)``."""
    edges = cut(spark, found.select("instance", "kind_no", F.explode(F.array(F.concat(F.lit("1 "), "l1"), F.concat(F.lit("2 "), "l2"))).alias("pattern"))
                .where(F.length("pattern") > 2).groupBy("pattern", "instance").agg(
                    F.count(F.lit(1)).alias("n"), *(F.max((F.col("kind_no") == k).cast("double")).alias(f"k{k}") for k in range(len(KINDS))))
                .na.fill(0.0), "pii-edges")
    kinds = range(len(KINDS))
    seeds = edges.groupBy("instance").agg(*(F.max(f"k{k}").alias(f"s{k}") for k in kinds))
    scores = cut(spark, seeds, "pii-scores")
    for _ in range(rounds):
        told = edges.select("pattern", "instance", "n").join(scores, "instance")
        patterns = told.groupBy("pattern").agg(
            *(F.when(F.sum((F.col(f"s{k}") > 0).cast("int")) >= MIN_SEEDS, F.sum(F.col("n") * F.col(f"s{k}")) / (F.sum("n") + PRIOR))
              .otherwise(0.0).alias(f"p{k}") for k in kinds))
        good = patterns.where(" or ".join(f"p{k} > 0" for k in kinds))
        best = edges.select("pattern", "instance").join(good, "pattern").groupBy("instance").agg(*(F.max(f"p{k}").alias(f"p{k}") for k in kinds))
        scores = cut(spark, seeds.join(best, "instance", "left").select(
            "instance", *(F.greatest(f"s{k}", F.coalesce(f"p{k}", F.lit(0.0))).alias(f"s{k}") for k in kinds)), "pii-scores")
    unseen = seeds.where(" and ".join(f"s{k} = 0" for k in kinds)).select("instance")
    shaped = [F.when(F.col("instance").rlike(SHAPE[kind]), F.col(f"s{k}")).otherwise(0.0) for k, kind in enumerate(KINDS)]
    top = F.greatest(*shaped)
    number = F.coalesce(*(F.when(s == top, F.lit(k)) for k, s in enumerate(shaped)))
    return scores.join(unseen, "instance").where(top >= threshold).select("instance", number.alias("kind_no"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
             threshold: float = THRESHOLD) -> DataFrame:
    """Per document row: counts and digest of the base spans, and all spans with those discovered."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    scanned = (docs.select(F.col(id_col).alias("id"), text.alias("text")).select("id", "text", base_spans(F.col("text")).alias("base"))
               .select("id", "base", with_context(F.col("text"), F.concat("base", candidates(F.col("text"), F.col("base")))).alias("found"))
               .select("id", F.transform("base", lambda s: F.struct(s["kind_no"], s["start"], s["end"])).alias("base"), "found"))
    scanned = cut(spark, scanned.withColumn("row", F.monotonically_increasing_id()), "pii-scan")
    told = scanned.where(F.size("found") > 0)
    found = told.select("row", F.explode("found").alias("f")).select("row", "f.*")
    new = cut(spark, bootstrap(spark, found, rounds, threshold), "pii-discovered")
    more = (found.where("kind_no is null").drop("kind_no").join(new, "instance").groupBy("row")
            .agg(F.collect_list(F.struct("kind_no", "start", "end")).alias("more")))
    none = F.array().cast("array<struct<kind_no:int,start:int,end:int>>")
    both = told.join(more, "row", "left").select("id", "base", F.coalesce("more", none).alias("more")).unionByName(
        scanned.where(F.size("found") == 0).select("id", "base", none.alias("more")))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind_no"] == k)).cast("long")
    return both.select(F.col("id").alias(id_col), *(count(no).alias(f"n_{kind}") for no, kind in enumerate(KINDS)),
                       F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                       joined(F.array_sort(F.concat("base", "more"))).alias("spans"), F.size("more").cast("long").alias("n_discovered"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return find_pii(table(spark, sf_dir, "documents"))
