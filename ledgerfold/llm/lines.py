"""Operator 10: line dedup with a log-template tree.  DataFrame functions only.

A line's tokens are its runs of anything but ASCII white space; tokens with a digit are variable fields and become <*>.
The tree has a fixed depth: the number of tokens, then the first LEAD tokens; that path is a leaf.  A leaf holds any
number of generalised templates: the seed of one is the line that most documents share among those that no template
before it took, and a line that agrees with the seed in at least SIMILAR of its places belongs to it, its other places
being variable; so until no line is left.  Templates that occur in at least MIN_DOCS documents recur; they stay in the document with
the smallest id that has them, whole, and are dropped from all others.  Lines of fewer than min_chars characters, as
they stand in the text, say too little to be a template and stay; op10_lines sets MIN_CHARS, as its SQL does, and the
pipeline 1, so that short lines too are judged by how many documents repeat them.  Blank lines stay.

Only the leaves that several documents share are looked at closely, and equal lines are one row there, so a line that a
third of all documents repeat is combined before it is dealt out.  Lines unlike the first seed meet seeds only where
they can be alike, and no leaf of many lines is gathered in one row or task.

Null texts have no lines and stay null; empty lines stay.  Rows with the same doc_id are one document when lines are
counted.  Rows without a doc_id drop and count nothing.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, Workspace, fields

LEAD = 3
SIMILAR = 0.7
MIN_DOCS = 3
MIN_CHARS = 20
#: Lines and characters up to which a leaf is gathered in one row.
FEW, FEW_CHARS = 1024, 4 << 20

_B, _NB = r"\x20\x09-\x0D", r"[^\x20\x09-\x0D]"
#: From a token's start only, and possessive, so that long tokens take time in proportion.
VARIABLE = rf"(?<!{_NB})[^{_B}0-9]*+[0-9]{_NB}*+"


def masked(line: Column) -> Column:
    """The line's tokens, variable ones as <*>, joined by one blank.  Most lines are that already and only looked at."""
    plain = F.when(line.rlike("[0-9]"), F.regexp_replace(line, VARIABLE, "<*>")).otherwise(line)
    odd = line.rlike(r"^\x20|[\x09-\x0D]|\x20\x20|\x20$")
    return F.when(odd, F.array_join(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0)), " ")).otherwise(plain)


def leaf(mask: Column) -> Column:
    """Number of tokens and first tokens; null where there is none."""
    tokens = F.length(mask) - F.length(F.replace(mask, F.lit(" "), F.lit(""))) + 1
    return F.when(F.length(mask) > 0, F.xxhash64(F.concat_ws(" ", tokens, F.substring_index(mask, " ", LEAD))))


def lines_of(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, nth, mask, leaf of the lines."""
    cut = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.posexplode(F.split("text", "\n")).alias("nth", "line")).where(F.length("line") >= min_chars)
    return cut.select("doc_id", "nth", masked(F.col("line")).alias("mask")).withColumn("leaf", leaf(F.col("mask")))


def agreeing(a: Column, b: Column) -> Column:
    """The share of places at which two arrays of as many tokens agree."""
    same = F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0))
    return F.aggregate(same, F.lit(0), lambda s, x: s + x) / F.size(same)


def alike(a: Column, b: Column) -> Column:
    """The share of places at which two masked lines of as many tokens agree."""
    return agreeing(F.split(a, " "), F.split(b, " "))


def part_keys(tokens: Column, similar: float) -> Column:
    """Keys of the parts of a masked line.  Lines of a leaf that differ in at most m places, none of them among the first
    LEAD, are equal in one of m + 1 parts."""
    size = F.size(tokens) - LEAD
    parts = F.floor(F.size(tokens) * (1 - similar) + 1e-6).cast("int") + 1
    cut = lambda b: F.floor(b * size / parts).cast("int")
    return F.transform(F.sequence(F.lit(0), parts - 1), lambda b: F.xxhash64(b, F.concat_ws(" ", F.slice(tokens, LEAD + 1 + cut(b), cut(b + 1) - cut(b)))))


def seeds_of(small: DataFrame, similar: float) -> DataFrame:
    """leaf, line of the seeds among the lines of leaves of few lines, each leaf gathered in one row."""
    each = small.select("leaf", F.struct("docs", "mask", "line").alias("x")).distinct()
    rows = each.groupBy("leaf").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: F.struct(x["line"].alias("line"), F.split(x["mask"], " ").alias("tokens"))).alias("all"))
    near = lambda seeds, x: F.exists(seeds, lambda s: agreeing(s["tokens"], x["tokens"]) >= similar)
    seeds = F.aggregate("all", F.slice("all", 1, 0), lambda seeds, x: F.when(near(seeds, x), seeds).otherwise(F.concat(seeds, F.array(x))))
    return rows.select("leaf", F.explode(seeds).alias("s")).select("leaf", F.col("s.line").alias("line"))


def further(rest: DataFrame, similar: float, ws: Workspace, few: int = FEW) -> DataFrame:
    """leaf, line, template of the lines that belong to a seed other than themselves, among those (leaf, line, mask,
    docs) that the first seed of their leaf left over.

    Seeds come in the order of documents, then mask, and what is like a seed is none.  Leaves of up to `few` lines that
    can be alike (and FEW_CHARS characters) are gone through one by one.  In larger ones, a line that comes first in each
    of its parts is unlike all before it, so it is a seed; it and what is like it go, and again until the leaf is small.
    A line then belongs to the first of the seeds it is like.  Only seeds are paired with lines.
    """
    ends = [F.min("line").alias("x"), F.max("line").alias("y")]
    cut = rest.select("leaf", "line", "mask", (-F.col("docs")).alias("docs"), F.split("mask", " ").alias("tokens"))
    keyed = ws.put(cut.select("leaf", "line", "mask", "docs", F.explode(part_keys(F.col("tokens"), similar)).alias("part")), "parts")
    met = ws.put(keyed.groupBy("leaf", "part").agg(*ends).where(F.col("x") != F.col("y")).select("leaf", "part"), "met")
    met = ws.put(keyed.join(met.hint("merge"), ["leaf", "part"]), "open-0")
    left, seeds, turn = met, [], 0
    while True:
        each = left.groupBy("leaf", "line").agg(F.max(F.length("mask")).alias("chars")).groupBy("leaf").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
        size = ws.put(each.select("leaf", ((F.col("n") <= few) & (F.col("chars") <= FEW_CHARS)).alias("small")), f"size-{turn}")
        seeds.append(ws.put(seeds_of(left.join(size.where("small").hint("merge"), "leaf", "left_semi"), similar), f"small-seeds-{turn}"))
        left, some = ws.counted(left.join(size.where("NOT small").hint("merge"), "leaf", "left_semi"), f"large-{turn}")
        if not some["n"]:
            break
        top = left.groupBy("leaf", "part").agg(F.min(F.struct("docs", "mask", "line")).alias("top")).select("leaf", "part", F.col("top.line").alias("top"), F.col("top.mask").alias("top_mask"))
        beside = left.join(ws.put(top, f"top-{turn}").hint("merge"), ["leaf", "part"])
        seeds.append(ws.put(beside.groupBy("leaf", "line").agg(F.bool_and(F.col("line") == F.col("top")).alias("seed")).where("seed").select("leaf", "line"), f"seeds-{turn}"))
        known = seeds[-1].select("leaf", F.col("line").alias("top"))
        gone = beside.join(known.hint("merge"), ["leaf", "top"]).where((F.col("line") == F.col("top")) | (alike(F.col("mask"), F.col("top_mask")) >= similar)).select("leaf", "line").distinct()
        turn += 1
        left = ws.put(left.join(ws.put(gone, f"gone-{turn}").hint("merge"), ["leaf", "line"], "left_anti"), f"open-{turn}")
    all_seeds = seeds[0]
    for more in seeds[1:]:
        all_seeds = all_seeds.unionAll(more)
    own = ws.put(met.join(all_seeds.hint("merge"), ["leaf", "line"]).select("leaf", "part", F.struct("docs", "mask", "line").alias("seed")), "own")
    like = met.join(own.hint("merge"), ["leaf", "part"]).where(alike(F.col("mask"), F.col("seed.mask")) >= similar)
    return like.groupBy("leaf", "line").agg(F.min("seed").alias("seed")).select("leaf", "line", F.col("seed.line").alias("template")).where(F.col("line") != F.col("template"))


def recurring(docs: DataFrame, min_docs: int = MIN_DOCS, similar: float = SIMILAR, ws: Workspace | None = None, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, nth of the lines to drop."""
    ws = ws or Workspace(docs.sparkSession, "lines")
    lines = lines_of(docs, min_chars)
    line = F.xxhash64("mask", F.lit(7)).alias("line")
    occ = ws.put(lines.select("doc_id", "nth", "leaf", line), "lines").where(F.col("leaf").isNotNull())
    # leaves of several documents; only those of several lines have to be read again.  All these tables grow with the
    # corpus, so none is broadcast
    leaves = occ.groupBy("leaf").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.min("line").alias("x"), F.max("line").alias("y")).where(F.col("a") != F.col("b"))
    leaves = ws.put(leaves.select("leaf", (F.col("x") != F.col("y")).alias("several")), "leaves")
    occ = ws.put(occ.join(leaves.hint("merge"), "leaf"), "shared")
    # each distinct line once, with the number of documents that have it, and one place where it stands: its text is read
    # again from there, so a line that a third of all documents repeat is neither dealt out by leaf nor gathered
    found = occ.where("several").groupBy("leaf", "line", "doc_id").agg(F.min("nth").alias("nth"))
    found = found.groupBy("leaf", "line").agg(F.count("*").alias("docs"), F.min("doc_id").alias("doc_id"), F.min_by("nth", "doc_id").alias("nth"))
    places = ws.put(found, "places")
    variants = lines.select("doc_id", "nth", "mask", line).join(places.hint("merge"), ["doc_id", "nth", "line"]).select("leaf", "line", "mask", "docs")
    variants = ws.put(variants, "variants")
    # written, so that a leaf of very many lines is a join that Spark can split
    seeds = ws.put(variants.groupBy("leaf").agg(F.min(F.struct((-F.col("docs")).alias("docs"), "mask", "line")).alias("seed")), "first-seeds")
    others = variants.join(seeds.hint("merge"), "leaf").where(F.col("line") != F.col("seed.line"))
    others = ws.put(others.withColumn("taken", alike(F.col("mask"), F.col("seed.mask")) >= similar), "others")
    of = others.where("taken").select("leaf", "line", F.col("seed.line").alias("template"))
    of = of.unionByName(further(others.where("NOT taken").select("leaf", "line", "mask", "docs"), similar, ws))
    of = ws.put(of.dropDuplicates(["leaf", "line"]), "templates")  # rows that share a doc_id may have told a line twice
    placed = occ.join(of.hint("merge"), ["leaf", "line"], "left").withColumn("template", F.coalesce("template", "line"))
    each = placed.groupBy("leaf", "template", "doc_id").agg(F.lit(1).alias("one")).groupBy("leaf", "template").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where(F.col("n") >= min_docs)
    each = ws.put(each, "recurring")
    return placed.join(each.hint("merge"), ["leaf", "template"]).where(F.col("doc_id") != F.col("first")).select("doc_id", "nth")


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, similar: float = SIMILAR, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with all its columns, text without the lines to drop, and n_lines_dropped."""
    ws = Workspace(docs.sparkSession, "lines")
    drops = ws.put(recurring(fields(docs, "doc_id", "text"), min_docs, similar, ws, min_chars).groupBy("doc_id").agg(F.collect_set("nth").alias("__gone")).withColumnRenamed("doc_id", "__doc"), "drops")
    rows = docs.join(drops.hint("merge"), docs["doc_id"] == drops["__doc"], "left")
    cut = F.split("text", "\n")
    # the place of a line tells it from its equals; rows that share a doc_id lose lines by place, so only where they are equal
    left = F.array_join(F.filter(cut, lambda line, i: ~F.array_contains("__gone", i)), "\n")
    n = F.when(F.col("text").isNotNull(), F.coalesce(F.size("__gone"), F.lit(0))).otherwise(0)
    kept = [F.when(F.col("__gone").isNull(), F.col("text")).otherwise(left).alias("text") if c == "text" else docs[c] for c in docs.columns]
    return rows.select(*kept, n.cast("long").alias("n_lines_dropped"))


def op10_lines(spark, sf_dir: str) -> DataFrame:
    out = drop_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def lines_sql(documents: str = "documents") -> str:
    """What op10_lines returns where no leaf has more than one template of several lines, as DuckDB SQL over the whole
    table: lines unlike the first seed of their leaf are each a template of their own there.  Lines whose mask has fewer
    than MIN_CHARS characters stay there too."""
    return f"""
WITH cut AS (
  SELECT doc_id, unnest(generate_series(0, len(l) - 1)) AS nth, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM {documents} WHERE doc_id IS NOT NULL AND text IS NOT NULL)),
masked AS (
  SELECT doc_id, nth, array_to_string(regexp_extract_all(regexp_replace(line, '[^\\x20\\x09-\\x0D]*[0-9][^\\x20\\x09-\\x0D]*', '<*>', 'g'), '[^\\x20\\x09-\\x0D]+'), ' ') AS mask
  FROM cut WHERE length(line) >= {MIN_CHARS}),
occ AS (
  SELECT *, concat_ws(' ', len(string_split(mask, ' ')), array_to_string(string_split(mask, ' ')[1:{LEAD}], ' ')) AS leaf
  FROM masked WHERE length(mask) >= {MIN_CHARS}),
variants AS (SELECT leaf, mask, count(DISTINCT doc_id) AS docs FROM occ GROUP BY leaf, mask),
seeds AS (
  SELECT leaf, mask AS seed FROM variants QUALIFY row_number() OVER (PARTITION BY leaf ORDER BY docs DESC, mask) = 1),
templates AS (
  SELECT v.leaf, v.mask, CASE WHEN list_sum(list_transform(list_zip(string_split(v.mask, ' '), string_split(s.seed, ' ')), lambda p: CASE WHEN p[1] = p[2] THEN 1 ELSE 0 END))
         / len(string_split(v.mask, ' '))::DOUBLE >= {SIMILAR} THEN s.seed ELSE v.mask END AS template
  FROM variants v JOIN seeds s USING (leaf)),
placed AS (SELECT o.doc_id, o.nth, leaf, t.template FROM occ o JOIN templates t USING (leaf, mask)),
recurs AS (
  SELECT leaf, template, min(doc_id) AS first FROM placed GROUP BY leaf, template HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
gone AS (SELECT DISTINCT doc_id, nth FROM placed JOIN recurs USING (leaf, template) WHERE doc_id <> first),
per_doc AS (SELECT doc_id, list(nth) AS nths FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(p.nths), 0)::BIGINT AS n_lines_dropped,
       sha256(CASE WHEN p.nths IS NULL THEN coalesce(d.text, '') ELSE
              array_to_string(list_transform(list_filter(list_zip(string_split(d.text, chr(10)), generate_series(0, len(string_split(d.text, chr(10))) - 1)), lambda x: NOT list_contains(p.nths, x[2])), lambda x: x[1]), chr(10)) END) AS kept_sha256
FROM {documents} d LEFT JOIN per_doc p ON d.doc_id = p.doc_id"""
