"""Personal data: base patterns, and bootstrapped contextual extraction.

Base spans of e-mail addresses, IP addresses, card and phone numbers seed the
method.  The words around a seed induce lexical patterns (two words before it;
one word before and one behind).  Patterns and the identifier-like tokens they
stand around form a graph that is scored in rounds: a pattern by the mean score
of its instances (with one unknown instance added, so few are not enough), an
instance by the patterns that extract it (noisy or).  Patterns that reach
``confidence`` with ``least_seeds`` different seeds find unseen identifiers:
tokens with a digit or an ``@``, and runs of tokens with a digit, that no base
span touches; of two found spans one within the other, the longer is reported.
What a sure pattern extracts is a seed of the next round.

Everything is DataFrame functions.  Texts are read once; spans and candidates,
a small part of the text, are written to the shared folder with their contexts.
Graph edges are distinct (pattern, instance) pairs, so a passage that a third of
all rows repeat is a few edges.

Regular expressions are written without backtracking (possessive, anchored at
the start of a run), which finds the same spans as the plain forms and stays
linear, with a flat stack, on very long runs.

Defined cases: a null text is empty; a text without spans has counts 0, the
digest of the empty string and an empty ``spans``; a row without an id keeps
its row; repeated rows are rows of their own; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import staged

#: Kinds in the order of the digest, found ones behind them.
KINDS = ("email", "ip", "card", "phone")
#: What each kind of span looks like; see the module's note on their form.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Tokens with a digit in a row, without punctuation that ends a clause between them.
RUN = r"(?<!\S)[^\s0-9]*+[0-9]\S*+(?:(?<![.,;:!?])[ \t]++[^\s0-9]*+[0-9]\S*+)++"
#: A cheap test that a text may hold a kind at all.
_MAY = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "candidate": "[0-9@]", "run": r"[0-9]\S*+[ \t]"}
ROUNDS, CONFIDENCE, LEAST_SEEDS = 3, 0.6, 3
#: Characters looked at for the words of a context.
CONTEXT = 64

_HIT = "array<struct<kind:string,pos:int,gap:int,hit:string,before:string,behind:string>>"


def _cut(docs: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Columns ``gaps_<kind>`` and ``hits_<kind>``: the text between the hits of each pattern, and the hits."""
    none = F.array().cast("array<string>")
    may = {k: F.col("t").rlike(_MAY[k]) for k in patterns}
    return docs.select("row", "doc_id", *(c for k, p in patterns.items() for c in (
        F.when(may[k], F.split("t", p, -1)).otherwise(none).alias(f"gaps_{k}"),
        F.when(may[k], F.regexp_extract_all("t", F.lit(p), F.lit(0))).otherwise(none).alias(f"hits_{k}"))))


def _hits(kind: str) -> Column:
    """Hits with the number of characters since the last one and the text around them, other hits in it or not."""
    gaps, hits = F.col(f"gaps_{kind}"), F.col(f"hits_{kind}")
    none = F.lit("")
    at = lambda c, i: F.coalesce(F.get(c, i), none)
    last = lambda c: F.substring(c, -CONTEXT, CONTEXT)
    fore = lambda c: F.substring(c, 1, CONTEXT)
    around = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"))
    # Two words before and one behind: at most two hits and one.
    before = lambda i: F.concat(*(last(at(c, i - k)) for k, c in ((2, gaps), (2, hits), (1, gaps), (1, hits), (0, gaps))))
    behind = lambda i: F.concat(*(fore(at(c, i + k)) for k, c in ((1, gaps), (1, hits), (2, gaps))))
    rows = F.transform(around, lambda z, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("pos"), F.length(z["gap"]).alias("gap"), z["hit"].alias("hit"),
        last(before(i)).alias("before"), fore(behind(i)).alias("behind")))
    return F.filter(rows, lambda z: z["hit"].isNotNull())


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(digits))
    total = F.aggregate(places, F.lit(0), lambda acc, i: acc + _luhn_digit(digits.substr(F.length(digits) - i + 1, F.lit(1)).cast("int"), i))
    return total % 10 == 0


def _luhn_digit(d: Column, i: Column) -> Column:
    double = d * 2
    return F.when(i % 2 == 1, d).otherwise(F.when(double > 9, double - 9).otherwise(double))


def _valid(kind: Column, hit: Column) -> Column:
    """Whether a base hit passes its kind's checks."""
    parts = F.forall(F.split(hit, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    n = F.length(_digits(hit))
    card = F.when(n.between(13, 19), _luhn(_digits(hit))).otherwise(False)
    return F.when(kind == "ip", parts).when(kind == "card", card).when(kind == "phone", n.between(9, 15)).otherwise(True)


def spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of every text: one marker (kind ''), its valid base spans, and candidates that touch none of them.

    row, doc_id, kind, start, end (code points), instance, patterns.  One shuffle, of hits alone.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), text.alias("t"))
    marker = F.array(F.struct(F.lit("").alias("kind"), F.lit(0).alias("pos"), F.lit(0).alias("gap"), F.lit("").alias("hit"),
                              F.lit("").alias("before"), F.lit("").alias("behind"))).cast(_HIT)
    patterns = PATTERNS | {"candidate": CANDIDATE, "run": RUN}
    rows = _cut(docs, patterns).select("row", "doc_id", F.inline(F.concat(marker, *map(_hits, patterns)))).repartition("row")
    ordered = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(ordered)).withColumn("start", F.col("end") - F.length("hit"))
    rows = rows.withColumn("kind", F.when(F.col("kind") == "run", "candidate").otherwise(F.col("kind")))
    rows = rows.filter((F.col("kind") == "") | (F.col("kind") == "candidate") | _valid(F.col("kind"), F.col("hit")))
    # A candidate is the token without the punctuation around it.
    is_candidate, edge = F.col("kind") == "candidate", r"[^\p{L}\p{N}]"
    lead = F.length("hit") - F.length(F.regexp_replace("hit", f"^{edge}++", ""))
    tail = F.length("hit") - F.length(F.regexp_replace("hit", f"(?<!{edge}){edge}++$", ""))
    rows = rows.withColumn("lead", F.when(is_candidate, lead).otherwise(0)).withColumn("tail", F.when(is_candidate, tail).otherwise(0))
    rows = rows.withColumn("hit", F.col("hit").substr(F.col("lead") + 1, F.length("hit") - F.col("lead") - F.col("tail")))
    rows = rows.withColumn("start", F.col("start") + F.col("lead")).withColumn("end", F.col("end") - F.col("tail"))
    is_base = F.col("kind").isin(*KINDS)
    up, down = (Window.partitionBy("row").orderBy(o("start")).rangeBetween(Window.unboundedPreceding, 0) for o in (F.asc, F.desc))
    reach, ahead = F.max(F.when(is_base, F.col("end"))).over(up), F.min(F.when(is_base, F.col("start"))).over(down)
    rows = rows.withColumn("reach", reach).withColumn("ahead", ahead)
    touched = (F.coalesce(F.col("reach"), F.lit(0)) > F.col("start")) | (F.coalesce(F.col("ahead") < F.col("end"), F.lit(False)))
    rows = rows.filter(~is_candidate | F.col("hit").rlike("[0-9@]") & ~touched)
    word = lambda c, pattern: F.lower(F.regexp_extract(c, pattern, 1))
    two = F.regexp_replace(word("before", r"(?<!\S)(\S++\s++\S++)\s*+$"), r"\s+", " ")
    one, next_one = word("before", r"(?<!\S)(\S++)\s*+$"), word("behind", r"^\s*+(\S++)")
    both = F.array(F.when(two != "", F.concat(F.lit("before "), two)),
                   F.when((one != "") & (next_one != ""), F.concat(F.lit("around "), one, F.lit(" | "), next_one)))
    return rows.select("row", "doc_id", "kind", "start", "end", F.lower("hit").alias("instance"),
                       F.when(F.col("kind") != "", F.array_compact(both)).otherwise(F.array().cast("array<string>")).alias("patterns"))


def _sure(confidence: float, least_seeds: int) -> Column:
    """Whether a pattern's finds are reported, and seeds of the next round."""
    return (F.col("seeds") >= least_seeds) & (F.greatest(*(F.col(f"s_{k}") for k in KINDS)) >= confidence)


def pattern_scores(found: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, least_seeds: int = LEAST_SEEDS) -> DataFrame:
    """Patterns of the graph: pattern, seeds (different instances that are base spans or what sure patterns extract), and a score per kind."""
    edges = staged(found.filter("kind <> ''").select(F.explode("patterns").alias("pattern"), "instance",
                   F.when(F.col("kind") != "candidate", F.col("kind")).alias("seed")).distinct(), "pii-edges")
    score = lambda k: f"s_{k}"
    seeds = edges.select("instance", *(F.when(F.col("seed") == k, 1.0).otherwise(0.0).alias(score(k)) for k in KINDS))
    instances = seeds.groupBy("instance").agg(*(F.max(score(k)).alias(score(k)) for k in KINDS)).withColumn("promoted", F.lit(False))
    unknown = edges.groupBy("instance").agg(F.max("seed").alias("s")).filter("s is null").select(F.col("instance").alias("i"))
    best = F.greatest(*(F.col(score(k)) for k in KINDS))
    patterns = None
    for _ in range(rounds):
        patterns = staged(edges.select("pattern", "instance", "seed").join(instances, "instance").groupBy("pattern").agg(
            F.count(F.when(F.col("seed").isNotNull() | F.col("promoted"), 1)).alias("seeds"),
            *((F.sum(score(k)) / (F.count(F.lit(1)) + 1)).alias(score(k)) for k in KINDS)), "pii-patterns")
        told = edges.join(unknown, F.col("instance") == F.col("i"), "left_semi").join(
            patterns.withColumn("sure", _sure(confidence, least_seeds)).withColumn("best", best), "pattern")
        guess = lambda k: 1 - F.exp(F.sum(F.log(1 - F.col(score(k)))))
        held = lambda k: F.max(F.when(F.col("sure") & (F.col(score(k)) == F.col("best")), 1.0).otherwise(0.0))
        guessed = told.groupBy("instance").agg(*(F.greatest(guess(k), held(k)).alias(score(k)) for k in KINDS), F.max("sure").alias("promoted"))
        sure = edges.filter("seed is not null").select("instance", *(F.when(F.col("seed") == k, 1.0).otherwise(0.0).alias(score(k)) for k in KINDS))
        known = sure.groupBy("instance").agg(*(F.max(score(k)).alias(score(k)) for k in KINDS)).withColumn("promoted", F.lit(False))
        instances = staged(known.unionByName(guessed), "pii-instances")
    return patterns


def extract(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, confidence: float = CONFIDENCE,
            least_seeds: int = LEAST_SEEDS) -> DataFrame:
    """All spans: row, doc_id, kind, start, end, found (by context).  Every text has at least its marker row (kind '')."""
    found = staged(spans(df, id_col, text_col), "pii-spans")
    patterns = pattern_scores(found, rounds, confidence, least_seeds)
    best = F.greatest(*(F.col(f"s_{k}") for k in KINDS))
    kind = F.coalesce(*(F.when(F.col(f"s_{k}") == best, F.lit(k)) for k in KINDS))
    sure = patterns.filter(_sure(confidence, least_seeds)).select(
        F.col("pattern").alias("p"), F.struct(best.alias("score"), kind.alias("kind")).alias("as"))
    unseen = found.filter("kind = 'candidate'").select("row", "doc_id", "start", "end", F.explode("patterns").alias("pattern"))
    new = unseen.join(sure, F.col("pattern") == F.col("p")).groupBy("row", "doc_id", "start", "end").agg(F.max("as").alias("as"))
    # Of a run and a token in it the run: it starts no later and ends no sooner.
    longer = Window.partitionBy("row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    new = new.withColumn("reach", F.max("end").over(longer)).filter("reach is null or reach < end")
    return (found.filter("kind <> 'candidate'").select("row", "doc_id", "kind", "start", "end", F.lit(False).alias("found"))
            .unionByName(new.select("row", "doc_id", F.col("as.kind").alias("kind"), "start", "end", F.lit(True).alias("found"))))


def digest(extracted: DataFrame) -> DataFrame:
    """One row per text: doc_id, n_<kind> of base spans, base_sha256, spans (found ones as ``context_<kind>``)."""
    order = F.coalesce(*(F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KINDS))) + F.when(F.col("found"), len(KINDS)).otherwise(0)
    name = F.concat(F.when(F.col("found"), "context_").otherwise(""), "kind")
    span = F.when(F.col("kind") != "", F.struct(order.alias("o"), F.col("start"), F.col("end"), F.concat_ws(":", name, F.col("start"), F.col("end")).alias("s")))
    joined = lambda c: F.array_join(F.transform(c, lambda x: x["s"]), ",")
    per = extracted.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(span)).alias("a"))
    base = F.filter("a", lambda x: x["o"] < len(KINDS))
    count = lambda i: F.size(F.filter("a", lambda x: x["o"] == i)).cast("long")
    return per.select("doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
                      F.sha2(joined(base), 256).alias("base_sha256"), joined("a").alias("spans"))
