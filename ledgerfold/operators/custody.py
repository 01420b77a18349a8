"""Chain of custody: a movement generator, and the recall drill."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.operators.folds import field, fold_state, history, known_by

STEPS = ("commission", "aggregate", "ship", "receive", "ship", "receive")
SPACING_MINUTES = 75


def movements(spark: SparkSession, ndcs: list[str], day: str, lots: int = 3, seed: int = 41, late: str = "19:45", depots: int = 3, pharmacies: int = 8) -> DataFrame:
    """Observations of lots on their way from plant by depot to pharmacy.

    Each choice is a hash of (seed, lot, what), so rows don't depend on the order in which they are made.  The last
    receipt of the first lot of each code is recorded late.  A ship event gives custody to its destination at once.
    """
    codes = spark.createDataFrame([(n,) for n in ndcs], "ndc string")
    lot = codes.select("ndc", F.explode(F.sequence(F.lit(1), F.lit(lots))).alias("no"))
    lot = lot.withColumn("lot", F.concat(F.lit("L"), F.lpad(F.col("no").cast("string"), 2, "0")))
    pick = lambda what, n: F.pmod(F.xxhash64(F.lit(seed), "ndc", "lot", F.lit(what)), F.lit(n))
    lot = lot.withColumns(
        {
            "depot": F.concat(F.lit("HUB-"), F.char(65 + pick("depot", depots))),
            "pharmacy": F.concat(F.lit("SHOP-"), (1 + pick("pharmacy", pharmacies)).cast("string")),
            "start": (360 + pick("start", 120)).cast("int"),
        }
    )
    rows = lot.select("*", F.posexplode(F.array(*[F.lit(s) for s in STEPS])).alias("step", "what"))
    minute = F.col("start") + F.col("step") * SPACING_MINUTES
    clock = F.concat(F.lit(f"{day}T"), F.lpad(F.floor(minute / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((minute % 60).cast("string"), 2, "0"))
    rows = rows.withColumn("event_time", clock)
    rows = rows.withColumn("record_time", F.when((F.col("step") == len(STEPS) - 1) & (F.col("no") == 1), F.lit(f"{day}T{late}")).otherwise(F.col("event_time")))
    plant = F.lit("MAKER")
    site = F.when(F.col("step") <= 2, plant).when(F.col("step") <= 4, F.col("depot")).otherwise(F.col("pharmacy"))
    to = F.when(F.col("step") == 2, F.col("depot")).when(F.col("step") == 4, F.col("pharmacy"))
    payload = F.to_json(F.struct(F.concat("lot", F.lit("-CASE")).alias("case_id"), F.coalesce(to, site).alias("holder_after"), "lot", "ndc", site.alias("site"), "step", to.alias("to")), {"ignoreNullFields": "false"})
    return rows.select(F.concat(F.lit("lot:"), "ndc", F.lit(":"), "lot").alias("entity_id"), "event_time", "record_time", payload.alias("payload"), F.concat(F.lit("epcis_"), "what").alias("event_type"))


def pick_recall(recalls: DataFrame) -> DataFrame:
    """The first record, by position, that names product codes: recall_number, ndcs (3 at most), description (80), and
    status and reason where records have them."""
    told = [F.col(c).alias(n) for c, n in (("status", "status"), ("reason_for_recall", "reason")) if c in recalls.columns]
    named = recalls.where(F.size(F.coalesce("openfda.product_ndc", F.array().cast("array<string>"))) > 0)
    return named.orderBy("position").limit(1).select("recall_number", F.slice("openfda.product_ndc", 1, 3).alias("ndcs"), F.substring("product_description", 1, 80).alias("description"), *told)


def holder_chain(versions: DataFrame) -> DataFrame:
    """entity_id, chain: the distinct holders in order of record, joined by arrows."""
    hops = F.array_sort(F.collect_list(F.struct(F.col("valid_from"), F.col("seq"), field("holder_after").alias("holder"))))
    chain = versions.groupBy("entity_id").agg(hops.alias("hops"))
    return chain.select("entity_id", F.array_join(F.array_distinct(F.transform("hops", lambda h: h["holder"])), " -> ").alias("chain"))


def drill(log: DataFrame, ndcs: list[str] | DataFrame, as_of: str, source: str, as_of_chain: bool = False) -> DataFrame:
    """lot, ndc, holder (as of then), last_event, chain: where every lot of the codes is, and how it came there.

    The chain is the whole history, also beyond as_of, unless as_of_chain says otherwise.
    """
    state = fold_state(log.where(F.col("source") == source), as_of).withColumn("ndc", field("ndc"))
    if isinstance(ndcs, DataFrame):
        state = state.join(ndcs, "ndc", "left_semi")
    else:
        state = state.where(F.col("ndc").isin(list(ndcs)))
    told = log.where(F.col("source") == source)
    chains = holder_chain(history(known_by(told, as_of) if as_of_chain else told, include_rescinded=False))
    return state.select(F.col("entity_id").alias("lot"), "entity_id", "ndc", field("holder_after").alias("holder"), F.col("event_type").alias("last_event")).join(chains, "entity_id", "left").drop("entity_id").orderBy("lot")


def lines(drilled: DataFrame) -> DataFrame:
    """lot, line: the drill as text of fixed width."""
    line = F.concat(F.rpad("lot", 24, " "), F.lit(" "), F.rpad(F.coalesce("holder", F.lit("?")), 10, " "), F.lit(" "), F.coalesce("chain", F.lit("")))
    return drilled.select("lot", line.alias("line"))


def render(drilled: DataFrame, title: str, recall: dict | None = None) -> str:
    """The drill as text, one line a lot, under its title and, if given, the recall's number, status and reason."""
    head = [title[:90]]
    if recall:
        head.append(f"{recall.get('recall_number') or '?'} [{recall.get('status') or '?'}] {recall.get('description') or ''}".rstrip())
        head += [f"because: {recall['reason'][:90]}"] if recall.get("reason") else []
    return "\n".join([*head, *(r["line"] for r in lines(drilled).orderBy("lot").toLocalIterator())])
