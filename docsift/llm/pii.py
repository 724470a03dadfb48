"""Personal data: base patterns, and identifiers that their contexts reveal.

Base spans are matches of fixed patterns, checked (parts of an address, Luhn sum, number
of digits). They seed a graph: an instance is an identifier or a string of a looser shape of
some kind, a pattern is what stands around it (the word or two words before it, the word
after it, or both). A pattern is as sure of a kind as the mean score of its instances; an instance
that is no seed gets the combined confidence of its patterns that `SUPPORT` seeds, or instances accepted
in an earlier round, share: what is found opens new patterns. After `ROUNDS` of this, instances that score `ACCEPT` or more are spans of the kind they score best for,
wherever they occur with such a pattern. Base spans stay.

Everything is DataFrame operations. The regular expressions are the stated ones, written so
that the matcher neither backtracks nor recurses over long runs. Spans count code points, the end is
exclusive. Null text is empty; rows are kept as they are, with repeated or null ids; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions.let import let, pieces
from docsift.llm import store

KINDS = ["email", "ip", "card", "phone"]
SUPPORT, ROUNDS, ACCEPT = 5, 3, 0.8

_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
EMAIL = (
    rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@(?=[{_LABEL}]++\.[{_LABEL}])(?:(?!\.(?![{_LABEL}]))[A-Za-z0-9.-])++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:(?![ -](?![0-9]))[0-9 -])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Looser shapes, for what the base patterns leave.
LOOSE_EMAIL = r"""(?<![^\s<>()",;:@])[^\s<>()",;:@]++@[^\s<>()",;:@]++"""
LOOSE_NUMBER = r"[+(]?[0-9](?:(?! (?![0-9(]))[0-9 ().-])++"
_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


_SIDE = "struct<l1:string,l2:string,r1:string>"


def _sides(before: Column, after: Column) -> Column:
    return F.struct(before["l1"].alias("l1"), before["l2"].alias("l2"), after["r1"].alias("r1"))


def spans(text: Column, pattern: str, words: bool = False) -> Column:
    """Matches with their places: array of struct(start, end, value), and if `words`, also the word `l1` before, the
    one before that, `l2`, and the word `r1` after: those of the whole text between a match and its neighbours."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    if words:
        listed = let(gaps, lambda g: F.transform(g, lambda x: F.filter(F.split(F.lower(x), r"\s+"), lambda w: w != "")))
        ends = F.transform(
            listed,
            lambda w: F.struct(
                F.try_element_at(w, F.lit(-1)).alias("l1"), F.try_element_at(w, F.lit(-2)).alias("l2"), F.try_element_at(w, F.lit(1)).alias("r1")
            ),
        )
        sides = let(ends, lambda e: F.zip_with(e, F.slice(e, F.lit(2), F.size(e)), _sides))
    else:
        sides = F.transform(gaps, lambda x: F.lit(False))
    pairs = F.arrays_zip(found.alias("value"), gaps.alias("gap"), sides.alias("side"))
    # The piece after the last match has no value.
    pairs = F.filter(pairs, lambda x: x["value"].isNotNull())
    none = F.array().cast(f"array<struct<start:int,end:int,value:string,side:{_SIDE if words else 'boolean'}>>")

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["value"])
        one = F.array(F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value"), x["side"].alias("side")))
        return F.struct(end.alias("at"), F.concat(acc["out"], one).alias("out"))

    # Places within each of many short runs of matches, then the runs put behind each other.
    runs = F.transform(pieces(pairs), lambda p: F.aggregate(p, F.struct(F.lit(0).alias("at"), none.alias("out")), step))

    def begins(runs: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        add = lambda acc, r: F.struct(
            (acc["at"] + r["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")
        )
        return F.aggregate(runs, start, add, lambda acc: acc["out"])

    def placed(run: Column, at: Column) -> Column:
        def moved(x: Column) -> Column:
            own = [(x["start"] + at).alias("start"), (x["end"] + at).alias("end"), x["value"].alias("value")]
            return F.struct(*own, *(x["side"][c].alias(c) for c in ("l1", "l2", "r1") if words))

        return F.transform(run["out"], moved)

    return let(runs, lambda r: F.flatten(F.zip_with(r, begins(r), placed)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a Luhn sum divisible by ten."""
    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))

    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(digits, F.length(digits) - i + 1, F.lit(1))) - 48
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _sized(value: Column, low: int, high: int) -> Column:
    return F.length(_digits(value)).between(low, high)


def base_spans(text: Column) -> dict[str, Column]:
    """The checked base spans of every kind."""
    none = F.array().cast("array<struct<start:int,end:int,value:string,l1:string,l2:string,r1:string>>")
    checks = {
        "email": (EMAIL, None),
        "ip": (IP, lambda x: x["value"].rlike(rf"^(?:{_BYTE}\.){{3}}{_BYTE}$")),
        "card": (CARD, lambda x: F.when(_sized(x["value"], 13, 19), luhn(_digits(x["value"]))).otherwise(F.lit(False))),
        "phone": (PHONE, lambda x: _sized(x["value"], 9, 15)),
    }
    needs = {"email": "@", "ip": ".", "phone": "+"}
    out = {}
    for kind, (pattern, check) in checks.items():
        found = spans(text, pattern, words=True)
        found = found if check is None else F.filter(found, check)
        has = F.contains(text, F.lit(needs[kind])) if kind in needs else F.lit(True)
        out[kind] = F.when(F.col("some") & has, found).otherwise(none)
    return out


def located(docs: DataFrame) -> DataFrame:
    """`doc_id, mark` and the base spans of `docs(doc_id, text)`, with the strings of looser
    shapes that overlap none of them, all with the text around them."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumns(
        {"mark": F.xxhash64("text"), "some": F.col("text").rlike("[0-9@]")}
    )
    rows = rows.withColumns(base_spans(F.col("text")))

    def kinds_of(x: Column) -> Column:
        value = x["value"]
        ip = value.rlike(r"^[0-9]{1,4}(?:\.[0-9]{1,4}){3,7}$")
        known = [
            F.when(F.contains(value, F.lit("@")), F.lit("email")),
            F.when(ip, F.lit("ip")),
            F.when(~F.contains(value, F.lit("@")) & ~ip & _sized(value, 13, 19), F.lit("card")),
            F.when(~F.contains(value, F.lit("@")) & ~ip & _sized(value, 7, 15), F.lit("phone")),
        ]
        return F.array_compact(F.array(*known))

    def with_context(x: Column, kinds: Column, seed: bool) -> Column:
        named = [x[c].alias(c) for c in ("start", "end", "value")]
        return F.struct(*named, kinds.alias("kinds"), F.lit(seed).alias("seed"), *(x[c].alias(c) for c in ("l1", "l2", "r1")))

    def run_of(p: Column) -> Column:
        ends = F.array_max(F.transform(p, lambda b: b["end"]))
        return F.struct(p[0]["start"].alias("first"), ends.alias("last"), p.alias("spans"))

    # Base spans in runs by their place: an overlap is looked for among the runs, then within one.
    every = F.array_sort(F.concat(*(F.transform(k, lambda x: F.struct(x["start"], x["end"])) for k in KINDS)))
    loose = F.concat(spans(F.col("text"), LOOSE_EMAIL, words=True), spans(F.col("text"), LOOSE_NUMBER, words=True))
    rows = rows.withColumn("base", F.when(F.size(every) > 0, F.transform(pieces(every), run_of)))

    def overlaps(x: Column, b: Column) -> Column:
        return (b["start"] < x["end"]) & (x["start"] < b["end"])

    taken = lambda x: F.exists(
        "base",
        lambda r: (r["first"] < x["end"]) & (x["start"] < r["last"]) & F.exists(r["spans"], lambda b: overlaps(x, b)),
    )
    free = F.filter(loose, lambda x: (F.size(kinds_of(x)) > 0) & (F.col("base").isNull() | ~taken(x)))
    # One argument each: a lambda of two would get the position as the second.
    def seeds_of(kind: str) -> Column:
        return F.transform(kind, lambda x: with_context(x, F.array(F.lit(kind)), True))

    seeds = F.concat(*map(seeds_of, KINDS))
    others = F.transform(free, lambda x: with_context(x, kinds_of(x), False))
    none = F.filter(seeds, lambda x: F.lit(False))
    rows = rows.withColumn("around", F.when(F.col("some"), F.concat(seeds, others)).otherwise(none))
    plain = {k: F.transform(k, lambda x: F.struct(x["start"], x["end"], x["value"])) for k in KINDS}
    return rows.withColumns(plain).select("doc_id", "mark", *KINDS, "around")


def _patterns(x: str) -> Column:
    """What stands around an occurrence; blank sides make no pattern."""
    l1, l2, r1 = (F.nullif(F.col(f"{x}.{c}"), F.lit("")) for c in ("l1", "l2", "r1"))
    shape = lambda c: F.regexp_replace(c, "[0-9]", "0")
    return F.array_compact(
        F.array(
            F.concat(F.lit("before "), shape(l1)),
            F.concat(F.lit("before "), shape(l2), F.lit(" "), shape(l1)),
            F.concat(F.lit("after "), shape(r1)),
            F.concat(F.lit("around "), shape(l1), F.lit(" | "), shape(r1)),
        )
    )


def discovered(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """`doc_id, mark, kind, start, end` of accepted instances that are no base spans."""
    each = rows.select("doc_id", "mark", F.explode("around").alias("x"))
    places = each.select(
        "doc_id", "mark", "x.start", "x.end", F.col("x.value").alias("instance"), F.col("x.seed").alias("seed"),
        F.explode("x.kinds").alias("kind"), _patterns("x").alias("patterns"),
    )
    uses = places.select("instance", "kind", "seed", F.explode("patterns").alias("pattern"))
    edges = uses.groupBy("pattern", "instance", "kind").agg(F.max("seed").alias("seed"))
    # A pattern of too few instances can never speak; only those that also hold others than seeds are of use.
    most = edges.groupBy("pattern", "kind").agg(F.count("*").alias("most"), F.bool_and("seed").alias("closed"))
    able = most.groupBy("pattern").agg(F.max("most").alias("most"), F.bool_and("closed").alias("closed"))
    able = able.where(f"most >= {SUPPORT} AND NOT closed").select("pattern")
    edges = store.keep(spark, edges.join(able, "pattern"), "pii-edges")
    sizes = edges.select("pattern", "instance").distinct().groupBy("pattern").agg(F.count("*").alias("n"))
    sizes = store.keep(spark, sizes, "pii-patterns")

    others = edges.where("NOT seed")
    scores = None
    for _ in range(ROUNDS):
        # An instance that was accepted for a kind counts like a seed of it.
        now = edges.withColumns({"score": F.lit(0.0), "accepted": F.lit(False)}) if scores is None else edges.join(
            scores, ["instance", "kind"], "left"
        )
        sure = now.groupBy("pattern", "kind").agg(
            F.sum(F.when(F.col("seed"), F.lit(1.0)).otherwise(F.coalesce("score", F.lit(0.0)))).alias("total"),
            F.count_if(F.col("seed") | F.coalesce("accepted", F.lit(False))).alias("support"),
        )
        sure = sure.where(f"support >= {SUPPORT}").join(sizes, "pattern")
        sure = sure.select("pattern", "kind", (F.col("total") / F.col("n")).alias("confidence"))
        sure = store.keep(spark, sure, "pii-confidence")
        heard = others.join(sure, ["pattern", "kind"])
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))
        # Patterns of one occurrence overlap: the surest counts, others add half of what is open.
        combined = F.greatest(F.max("confidence"), (1 - doubt) * 0.5 + F.max("confidence") * 0.5)
        each = heard.groupBy("instance", "kind").agg(combined.alias("score")).groupBy("instance")
        each = each.agg(F.collect_list(F.struct("score", "kind")).alias("all"))
        each = each.select("instance", F.array_max("all").alias("best"), F.explode("all").alias("x"))
        accepted = (F.col("x.score") >= ACCEPT) & (F.col("x.kind") == F.col("best.kind"))
        scores = each.select("instance", "x.kind", "x.score", accepted.alias("accepted"))
        scores = store.keep(spark, scores, "pii-scores")
    best = scores.where("accepted").select("instance", "kind")
    trusted = sure.where(F.col("confidence") >= ACCEPT / 2).select("pattern", "kind")
    found = places.where("NOT seed").join(best, ["instance", "kind"])
    found = found.select("doc_id", "mark", "kind", "start", "end", F.explode("patterns").alias("pattern"))
    return found.join(trusted, ["pattern", "kind"]).select("doc_id", "mark", "kind", "start", "end").distinct()


def find(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """`doc_id`, the base spans by kind, and `found`: all spans as struct(number of the kind, start, end)."""
    rows = store.keep(spark, located(docs), "pii-rows")
    more = discovered(spark, rows)
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    span = F.struct(number.alias("kind"), "start", "end")
    more = more.groupBy("doc_id", "mark").agg(F.collect_set(span).alias("more"))
    more = store.keep(spark, more.withColumnRenamed("doc_id", "of"), "pii-found")

    def numbered(i: int) -> Column:
        return F.transform(KINDS[i - 1], lambda x: F.struct(F.lit(i).alias("kind"), x["start"], x["end"]))

    base = F.concat(*map(numbered, range(1, len(KINDS) + 1)))
    joined = rows.drop("around").join(more, F.col("doc_id").eqNullSafe(F.col("of")) & (rows["mark"] == more["mark"]), "left")
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return joined.select(
        "doc_id", *KINDS, base.alias("base"), F.array_sort(F.concat(base, F.coalesce("more", none))).alias("found")
    )


def _listed(found: str) -> Column:
    name = lambda i: F.element_at(F.array(*map(F.lit, KINDS)), i)
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", name(x["kind"]), x["start"], x["end"])), ",")


def report(found: DataFrame) -> DataFrame:
    """The digest columns of the query."""
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"),
        _listed("found").alias("spans"),
    )
