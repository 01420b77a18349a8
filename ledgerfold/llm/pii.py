"""Operator 9: personal data, and what gives it away, by corpus co-occurrence.  DataFrame functions only.

Base spans are e-mail addresses, IP addresses, card and phone numbers, by pattern and check.  Each gives protected
entities at three LEVELS: its exact value, the group that value is of (an address's mail domain, an IP's network of
three numbers, a card's issuer prefix of six digits, a phone's first four digits), and its kind.  A term (a run of three
or more letters, lower-cased) in a document that holds an entity is a possible clue to it.  With n documents, of which
n(t) hold the term, n(e) the entity and n(t,e) both,

    disclosure = log(n(t,e) * n / ((n(t) + PRIOR) * n(e))) / log(n / n(e))

is the pointwise mutual information over the entity's own information: 1 where the term never appears without the
entity.  PRIOR documents that hold the term without the entity are added for groups and kinds, which are common enough
for chance to put a rare term next to them: the commoner the entity, the more documents it takes to be sure.  Pairs seen
in fewer than SUPPORT different texts tell nothing.  Terms of at least their level's THRESHOLD are generalised (to
<TERM>), those of 1 removed, wherever they stand in a document that holds that entity; terms that overlap a base span
are left to it.  As n(t,e) <= n(e), disclosure is at most log(n / n(t)) / log(n / n(e)); pairs for which that is below
the threshold are not looked at, which changes no result.

Patterns are anchored at run starts and possessive, so texts of any length take time in proportion, and match exactly
what the plain patterns match.  Null texts count as empty.  Rows that repeat get the same result each; spans are
joined to a row by doc_id and text, so rows with the same or no doc_id do not mix.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, fields

SUPPORT = 2
LEVELS = ("value", "group", "kind")
THRESHOLDS = (0.9, 0.9, 0.9)
PRIOR = (0, 1, 1)

_LOCAL = "[A-Za-z0-9._%+-]"
#: In the order in which kinds are listed.  \G: a match may start right where the one before it ended.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
LETTERS = r"\p{L}{3,}+"


def digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def checked(kind: str, v: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(v, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.lpad(F.ltrim(p, F.lit("0")), 3, "0") <= "255"))
    if kind == "card":
        d = digits(v)
        return F.length(d).between(12, 19) & F.call_function("luhn_check", d)
    if kind == "phone":
        return F.length(digits(v)).between(9, 15)
    return F.lit(True)


def located(text: Column, matches: Column, pattern: str) -> Column:
    """The matches with start and end, in characters: what stands between them is split off and its lengths summed."""
    between = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.zip_with(F.slice(between, 1, F.size(matches)), matches, lambda gap, m: F.struct(gap.alias("gap"), m.alias("value")))
    kind = "struct<at:int,found:array<struct<start:int,end:int,value:string>>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("found")).cast(kind)
    return F.aggregate(
        steps,
        start,
        lambda a, x: F.struct(
            (a["at"] + x["gap"] + F.length(x["value"])).alias("at"),
            F.concat(a["found"], F.array(F.struct((a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + F.length(x["value"])).alias("end"), x["value"].alias("value")))).alias("found"),
        ).cast(kind),
    )["found"]


def spans_of_kind(n: int, kind: str, pattern: str) -> Column:
    """The good ones among the matches in column m_<kind>; they are located only where there are any."""
    m = F.col(f"m_{kind}")
    good = F.filter(located(F.col("text"), m, pattern), lambda s: checked(kind, s["value"]))
    found = F.transform(good, lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    return F.when(F.coalesce(F.exists(m, lambda v: checked(kind, v)), F.lit(False)), found).otherwise(none)


def base(docs: DataFrame) -> DataFrame:
    """The rows with text and spans: array of (start, kind number, end, value), sorted."""
    rows = docs
    for kind, p in PATTERNS.items():
        text = F.col("text")
        here = F.contains(text, F.lit("@" if kind == "email" else "+")) if kind in ("email", "phone") else F.lit(True)
        rows = rows.withColumn(f"m_{kind}", F.when(here, F.regexp_extract_all("text", F.lit(p), F.lit(0))))
    parts = [spans_of_kind(n, kind, p) for n, (kind, p) in enumerate(PATTERNS.items())]
    return rows.withColumn("spans", F.array_sort(F.concat(*parts))).drop(*[f"m_{k}" for k in KINDS])


def named(span: Column) -> Column:
    return F.concat_ws(":", F.element_at(F.array(*[F.lit(k) for k in (*KINDS, "term")]), span["kind"] + 1), span["start"], span["end"])


def terms_of(text: Column) -> Column:
    """The terms of a text, in order, once for each place."""
    return F.transform(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0)), F.lower)


def entities_of(span: Column) -> Column:
    """What a base span protects, as array of (level, entity)."""
    kind, v = span["kind"].cast("string"), F.lower(span["value"])
    value = F.when(span["kind"] <= 1, v).otherwise(digits(v))
    group = F.when(span["kind"] == 0, F.substring_index(v, "@", -1)).when(span["kind"] == 1, F.substring_index(v, ".", 3)).otherwise(F.substring(digits(v), 1, F.when(span["kind"] == 2, 6).otherwise(4)))
    return F.array(*[F.struct(F.lit(i).alias("level"), F.concat_ws(":", *parts).alias("entity")) for i, parts in enumerate(((kind, value), (kind, group), (kind,)))])


def by_level(values: tuple) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("level") + 1)


def disclosures(texts: DataFrame, holds: DataFrame, terms: DataFrame, n: int, support: int, thresholds: tuple) -> DataFrame:
    """level, entity, term, disclosure at or above the threshold, from texts (id, text), holds (id, level, entity, docs
    that are copies of the text, n_entity) and terms (term, n_term)."""
    words = texts.select("id", F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term"))
    both = words.join(holds, "id").groupBy("level", "entity", "n_entity", "term").agg(F.sum("docs").alias("both"), F.count("*").alias("texts")).where(F.col("texts") >= support)
    pairs = both.join(terms.where(F.col("n_term") >= support).hint("merge"), "term")
    # with n(e) = n the entity has no information to give away
    own = F.log(F.lit(n) / F.col("n_entity"))
    pairs = pairs.where(F.log(F.lit(n) / F.col("n_term")) >= by_level(thresholds) * own - 1e-9)
    share = F.when(own > 0, F.log(F.col("both") * F.lit(n) / ((F.col("n_term") + by_level(PRIOR)) * F.col("n_entity"))) / own)
    return pairs.withColumn("disclosure", share).where(F.col("disclosure") >= by_level(thresholds)).select("level", "entity", "term", "disclosure")


def told_at(text: Column, told: Column) -> Column:
    """The places of the terms in the map told, as (start, kind, end, value); the text is gone through once."""
    kind = "struct<at:int,found:array<struct<start:int,kind:int,end:int,value:string>>>"
    matches = F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))
    gaps = F.slice(F.transform(F.split(text, LETTERS, -1), F.length), 1, F.size(matches))
    steps = F.zip_with(gaps, matches, lambda gap, m: F.struct(gap.alias("gap"), F.length(m).alias("size"), F.element_at(told, F.lower(m)).alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>").alias("found")).cast(kind)

    def step(a: Column, x: Column) -> Column:
        first, end = a["at"] + x["gap"], a["at"] + x["gap"] + x["size"]
        one = F.array(F.struct(first.alias("start"), F.lit(len(KINDS)).alias("kind"), end.alias("end"), x["value"].cast("string").alias("value")))
        return F.struct(end.alias("at"), F.when(x["value"].isNull(), a["found"]).otherwise(F.concat(a["found"], one)).alias("found")).cast(kind)

    return F.aggregate(steps, start, step)["found"]


def find(docs: DataFrame, support: int = SUPPORT, thresholds: tuple = THRESHOLDS) -> DataFrame:
    """doc_id, id (of the text), base and terms: arrays of (start, kind number, end, value), where kind 4 is a term and
    value its disclosure, the highest if several entities of the document have it."""
    ws = Workspace(docs.sparkSession, "pii")
    docs = fields(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit(""))).withColumn("id", F.md5("text"))
    full = ws.put(base(docs).select("doc_id", "id", F.col("spans").alias("base")), "base")
    # each text is told once, with the number of rows that are it
    held = full.where(F.size("base") > 0).select("id", F.explode(F.array_distinct(F.flatten(F.transform("base", entities_of)))).alias("e"))
    holds = ws.put(held.select("id", "e.*").groupBy("level", "entity", "id").agg(F.count("*").alias("docs")), "holds")
    entities = holds.groupBy("level", "entity").agg(F.sum("docs").alias("n_entity"), F.count("*").alias("texts")).where(F.col("texts") >= support).drop("texts")
    holds = ws.put(holds.join(entities.hint("merge"), ["level", "entity"]), "shared")
    texts = ws.put(docs.join(holds.select("id").distinct().hint("merge"), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text")), "texts")
    # combined within each task before the terms are dealt out
    terms = docs.select(F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    told = ws.put(disclosures(texts, holds, terms, docs.count(), support, thresholds), "told")
    words = texts.select("id", F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term"))
    told = words.join(told, "term").join(holds.select("id", "level", "entity").hint("merge"), ["id", "level", "entity"]).groupBy("id", "term").agg(F.max("disclosure").alias("disclosure"))
    told = told.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("told"))
    terms = ws.put(texts.join(told.hint("merge"), "id").select("id", told_at(F.col("text"), F.col("told")).alias("terms")), "terms")
    out = full.join(terms.hint("merge"), "id", "left")
    clear = F.filter(F.coalesce(F.col("terms"), F.array().cast(terms.schema["terms"].dataType)), lambda t: ~F.exists(F.col("base"), lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return out.select("doc_id", "id", "base", clear.alias("terms"))


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """doc_id, text, with base spans replaced by their kind, terms generalised, and those that disclose all removed."""
    found = find(docs, **options)
    rows = fields(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit(""))).withColumn("id", F.md5("text"))
    rows = rows.dropDuplicates(["doc_id", "id"]).alias("r").join(found.alias("f"), F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("r.id") == F.col("f.id")))
    label = lambda s: F.when(s["kind"] < len(KINDS), F.concat(F.lit("<"), F.upper(F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.least(s["kind"], F.lit(len(KINDS) - 1)) + 1)), F.lit(">"))).when(s["value"].cast("double") >= 1, F.lit("")).otherwise(F.lit("<TERM>"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    # a span that starts within one already replaced only extends what is left out
    step = lambda a, s: F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]), label(s))).alias("out"))
    done = F.aggregate(F.array_sort(F.concat("base", "terms")), start, step)
    return rows.withColumn("done", done).select("r.doc_id", F.concat("done.out", F.substring("text", F.col("done.at") + 1, F.length("text"))).alias("text"))


def op9_pii(spark, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    number = lambda n: F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long")
    counts = [number(n).alias(f"n_{k}") for n, k in enumerate(KINDS)]
    joined = lambda c: F.array_join(F.transform(c, named), ",")
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.array_sort(F.concat("base", "terms"))).alias("spans"))
