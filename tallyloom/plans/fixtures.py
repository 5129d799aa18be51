"""The three message streams, derived from the given tables on Spark.

``events`` becomes transform, analysis and collection-done messages, ``orders``
a control log, ``lineitem`` a large transform stream with natural copies, and
``documents`` messages that carry whole texts. Every row of a
table takes part; the messages vary by the values of the row, so that all
parsing rules are met. ``oracle.py`` states the same rows as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyloom import schema as S
from tallyloom.functions import scalars as sc

RESENT = "purchase"  # events delivered a second time, one second later
NAMELESS = 7
ODD = "error"  # events whose analysis message holds no usable result


def table(spark: SparkSession, sf_dir: str, name: str, streaming: bool = False) -> DataFrame:
    """A given table; timestamps without zone become instants (UTC session)."""
    path = f"{sf_dir}/{name}.parquet"
    if streaming:
        layout = spark.read.parquet(path).schema
        # as a pattern, the path may be one file as well as a folder of files
        df = spark.readStream.schema(layout).parquet(f"{sf_dir}/{name}.[p]arquet")
    else:
        df = spark.read.parquet(path)
    naive = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """Rows dealt over the tasks by what they hold. A file of a few large row groups is read by as many
    tasks, which is too few for making and parsing messages; null and repeated keys meet only with the rest alike.
    The number of tasks is given: by their few bytes adaptive execution would merge them into too few for the work on them."""
    return rows if rows.isStreaming else rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _json(**fields: Column) -> Column:
    """Fields that are null stay absent."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))


def _variant(expr: str) -> str:
    return f"CAST({expr} AS VARIANT)"


def _review_id(anonymous: bool) -> Column:
    return F.expr(f"CASE WHEN event_id % {NAMELESS} <> 0 OR {not anonymous} THEN concat('r', event_id) END")


def transform_messages(
    spark: SparkSession, sf_dir: str, streaming: bool = False, anonymous: bool = False, since=None, until=None
) -> DataFrame:
    """``(key, value, ts, redelivery)`` from events. With ``anonymous`` every
    ``NAMELESS``-th review has no id. ``since`` and ``until`` (excluded) bound ``ts``."""
    events = table(spark, sf_dir, "events", streaming)
    # a bound on what each event sends would be asked after the rows are dealt out
    if since is not None:
        events = events.filter((F.col("ts") >= F.lit(since)) | (_last_sent() >= F.lit(since)))
    if until is not None:
        events = events.filter(F.col("ts") < F.lit(until))
    events = spread(events, "event_id", "ts", "user_id", "value").withColumns(
        {
            "_rating": F.expr("CAST(FLOOR(value) AS BIGINT) % 12 / 2"),
            "_k": F.regexp_extract("props", "([0-9]+)", 1),
        }
    )
    sends = F.when(F.col("event_type") == RESENT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = events.withColumn("redelivery", F.explode(sends))
    rating = F.expr(
        f"""CASE event_type WHEN 'click' THEN {_variant('_rating')}
            WHEN 'signup' THEN {_variant('CAST(_rating AS STRING)')}
            WHEN 'error' THEN {_variant("'n/a'")}
            WHEN 'view' THEN parse_json('null') END"""
    )
    keywords = F.expr(
        f"""map_filter(map(
              '품질', {_variant('event_type')},
              '배송', CASE WHEN event_type <> 'view'
                      THEN {_variant("CASE WHEN value < 20 THEN 'fast' ELSE 'slow' END")} END,
              concat('속성-', _k), {_variant("'있음'")},
              '점수', {_variant('CAST(FLOOR(value) AS BIGINT) % 3')},
              '빈값', {_variant("''")}), (k, v) -> v IS NOT NULL)"""
    )
    value = _json(
        job_id=F.expr("concat('job-', user_id)"),
        review_id=_review_id(anonymous),
        rating=rating,
        overall_star_rating=F.expr("CASE WHEN event_type = 'view' THEN _rating END"),
        star_rating=F.expr("CASE WHEN event_type IN ('purchase', 'error') THEN _rating END"),
        is_valid=F.expr(
            f"CASE WHEN event_id % 11 = 0 THEN {_variant('0')} WHEN event_id % 2 = 0 THEN {_variant('true')} END"
        ),
        is_empty_review=F.expr("CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END"),
        is_coupang_trial=F.expr(
            f"CASE WHEN event_type = 'view' THEN {_variant('CAST(INT(event_id % 3 = 0) AS STRING)')} "
            f"ELSE {_variant('INT(event_id % 3 = 0)')} END"
        ),
        keywords=keywords,
        clean_text=F.col("props"),
        title=F.col("event_type"),
        sales_price=F.expr("CAST(FLOOR(value) AS INT)"),
        year=F.year("ts"),
        invalid_reason=F.expr("CASE WHEN event_id % 11 = 0 THEN array('rating') END"),
    )
    sent = F.col("ts") + F.col("redelivery") * F.expr("INTERVAL 1 SECOND")
    if since is not None:
        rows = rows.filter(sent >= F.lit(since))
    if until is not None:
        rows = rows.filter(sent < F.lit(until))
    return rows.select(
        F.lit(None).cast("string").alias("key"), value.alias("value"), sent.alias("ts"), "redelivery"
    )


def _last_sent() -> Column:
    return F.when(F.col("event_type") == RESENT, F.expr("ts + INTERVAL 1 SECOND")).otherwise(F.col("ts"))


def transform_times(spark: SparkSession, sf_dir: str) -> Row:
    """The first and last ``ts`` of ``transform_messages`` as ``(a, z)``, without making them."""
    return table(spark, sf_dir, "events").agg(F.min("ts").alias("a"), F.max(_last_sent()).alias("z")).first()


def analysis_messages(
    spark: SparkSession, sf_dir: str, streaming: bool = False, anonymous: bool = False
) -> DataFrame:
    """``(value, ts)`` from events: results lists; some list a result without job.

    Those of ``ODD`` events have a text, an empty list or nothing for results,
    a result with a null job id, or are broken JSON.
    """
    events = spread(table(spark, sf_dir, "events", streaming), "event_id", "ts", "user_id", "value")
    result = F.struct(
        F.expr("concat('job-', user_id)").alias("job_id"),
        _review_id(anonymous).alias("review_id"),
        F.expr(
            f"""CASE WHEN value < 10 THEN '{S.NEGATIVE}' WHEN value < 40 THEN '{S.POSITIVE}'
                WHEN value < 80 THEN '{S.NEUTRAL}' WHEN value < 100 THEN '혼합' END"""
        ).alias("sentiment"),
        F.col("event_type").alias("summary"),
        F.expr("INT(event_id % 3 = 0 OR event_type = 'click')").alias("is_coupang_trial"),
    )
    orphan = F.struct(
        F.lit("").alias("job_id"),
        F.expr("concat('r', event_id)").alias("review_id"),
        F.lit(S.POSITIVE).alias("sentiment"),
        F.lit("orphan").alias("summary"),
        F.lit(0).alias("is_coupang_trial"),
    )
    results = F.when(F.col("event_type") == "signup", F.array(result, orphan)).otherwise(F.array(result))
    later = F.expr("ts + (event_id % 181) * INTERVAL 1 SECOND")
    odd = F.expr(
        """CASE event_id % 5 WHEN 0 THEN '{"results":"none"}' WHEN 1 THEN '{"results":[]}' WHEN 2 THEN '{}'
           WHEN 3 THEN concat('{"results":[{"job_id":null,"review_id":"r', event_id, '","sentiment":"odd"}]}')
           ELSE '{"results":[{' END"""
    )
    value = F.when(F.col("event_type") == ODD, odd).otherwise(_json(results=results))
    return events.select(value.alias("value"), later.alias("ts"))


def collection_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key, value, ts)``: a collection-done message per events job."""
    jobs = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("_n"), F.max("ts").alias("ts")
    )
    expected = F.expr(
        "CASE user_id % 4 WHEN 1 THEN _n WHEN 3 THEN _n + 5 ELSE GREATEST(_n - 30, 0) END"
    )
    value = _json(
        job_id=F.expr("CASE WHEN user_id % 5 <> 0 THEN concat('job-', user_id) END"),
        step=F.lit("collection"),
        status=F.lit("done"),
        expected_count=expected,
        actual_count=F.col("_n"),
        timestamp=sc.kst_iso(F.col("ts")),
    )
    return jobs.select(F.expr("concat('\"job-', user_id, '\"')").alias("key"), value.alias("value"), "ts")


POSITION = ["position"]


def positioned(messages: DataFrame) -> DataFrame:
    """Transform messages with the position they were read from."""
    place = F.concat_ws("/", F.get_json_object("value", "$.review_id"), "redelivery")
    return messages.withColumn("position", place)


def broken(messages: DataFrame) -> DataFrame:
    """About a third of the messages lose their last brace."""
    cut = F.expr("CASE WHEN crc32(position) % 3 = 0 THEN substring(value, 1, length(value) - 1) ELSE value END")
    return messages.withColumn("value", cut)


def repairs(messages: DataFrame) -> DataFrame:
    """``(position, value, repaired_at)``: an unreadable attempt and a wrong one, then the right value of each broken
    message; a wrong value for messages that need none and for a position that never was."""
    hour = lambda n: F.col("ts") + F.lit(n) * F.expr("INTERVAL 1 HOUR")
    wrong = F.lit('{"job_id":"job-0","review_id":"wrong"}')
    tries = F.array(
        F.struct(wrong.alias("value"), hour(1).alias("repaired_at")),
        F.struct(F.when(F.expr("crc32(position) % 3 = 0"), F.col("value")).otherwise(wrong).alias("value"), hour(2).alias("repaired_at")),
        F.struct(F.lit("[").alias("value"), hour(3).alias("repaired_at")),
    )
    listed = messages.select("position", F.inline(tries))
    nowhere = messages.sparkSession.range(1).select(F.lit("nowhere").alias("position"), wrong.alias("value"), F.current_timestamp().alias("repaired_at"))
    return listed.unionByName(nowhere)


def deletion_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key, value, ts)``: messages without a value for some reviews of ``transform_messages``, by their composite key.

    Those of purchases come between the review and its re-delivery, so the review is back.
    """
    events = table(spark, sf_dir, "events").filter("event_id % 7 = 0")
    key = F.expr("concat('job-', user_id, '|r', event_id)")
    return events.select(key.alias("key"), F.lit(None).cast("string").alias("value"), F.expr("ts + INTERVAL 0.5 SECONDS").alias("ts"))


def control_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key, value, ts)``: one control message per order.

    Messages of the lowest priority lack one of the six required fields, each
    in turn; every seventh of them has a null status instead.
    """
    orders = table(spark, sf_dir, "orders")
    lacks = F.expr("CASE WHEN o_orderpriority LIKE '5%' THEN CAST(o_orderkey % 7 AS INT) ELSE 7 END")
    unless = lambda i, value: F.when(lacks != i, value)
    expected = F.expr("CAST(FLOOR(o_totalprice / 100) AS INT)")
    actual = F.expr(
        "CAST(FLOOR(o_totalprice / 100) AS INT) - CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey % 3 END"
    )
    value = _json(
        job_id=unless(0, F.expr("concat('job-', o_custkey)")),
        step=unless(1, F.expr(
            """CASE WHEN o_orderpriority LIKE '1%' THEN 'collection' WHEN o_orderpriority LIKE '2%' THEN 'transform'
               WHEN o_orderpriority LIKE '3%' THEN 'analysis' WHEN o_orderpriority LIKE '4%' THEN 'aggregation'
               ELSE 'publish' END"""
        )),
        status=unless(2, F.expr("CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'failed' ELSE 'timeout' END")),
        expected_count=unless(3, expected),
        actual_count=unless(4, actual),
        timestamp=unless(5, sc.kst_iso(F.col("o_orderdate"))),
        metadata=F.struct(F.expr("FLOOR(o_totalprice) / 2").alias("processing_time")),
    )
    value = F.when(lacks == 6, F.regexp_replace(value, '"status":"[a-z]+"', '"status":null')).otherwise(value)
    return orders.select(
        F.expr("concat('job-', o_custkey)").alias("key"), value.alias("value"), F.col("o_orderdate").alias("ts")
    )


def lineitem_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(value, ts, l_partkey, l_extendedprice)``: volume, with natural copies."""
    value = _json(
        job_id=F.expr("concat('job-', l_suppkey)"),
        review_id=F.expr("concat(l_orderkey, '-', l_linenumber)"),
        rating=F.expr("FLOOR((l_quantity - 1) / 5) / 2 + 0.5D"),
        is_coupang_trial=F.expr("INT(l_linestatus = 'O')"),
        is_empty_review=F.expr("INT(l_quantity <= 3)"),
        is_valid=F.expr("INT(l_returnflag <> 'R')"),
    )
    return table(spark, sf_dir, "lineitem").select(
        value.alias("value"), F.col("l_shipdate").alias("ts"), "l_partkey", "l_extendedprice"
    )


def document_messages(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    """``(doc_id, value)``: whole texts, one job per source. With ``damaged``,
    German texts lose their last brace and Spanish ones are wrapped in a list."""
    value = _json(
        job_id=F.col("source"),
        review_id=F.expr("concat('d', doc_id)"),
        rating=F.expr("doc_id % 11 / 2"),
        is_empty_review=F.expr("INT(n_chars < 200)"),
        is_coupang_trial=F.expr("INT(lang <> 'en')"),
        clean_text=F.col("text"),
    )
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", value.alias("value"))
    if damaged:
        rows = rows.withColumn(
            "value",
            F.expr(
                """CASE lang WHEN 'de' THEN substring(value, 1, length(value) - 1)
                   WHEN 'es' THEN concat('[', value, ']') ELSE value END"""
            ),
        )
    return rows.drop("lang")


def batch_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(l_extendedprice, value)``: the older shape. Finished line items list
    their reviews (returned ones a second one) next to the job of the message;
    open ones are a review themselves."""
    listed = F.expr(
        """CASE WHEN l_linestatus = 'F' THEN filter(array(
             named_struct('review_id', concat(l_orderkey, '-', l_linenumber), 'rating', l_quantity),
             CASE WHEN l_returnflag = 'R' THEN
               named_struct('review_id', concat(l_orderkey, '-', l_linenumber, '-r'), 'rating', l_tax) END),
           r -> r IS NOT NULL) END"""
    )
    is_open = F.col("l_linestatus") == "O"
    value = _json(
        job_id=F.expr("concat('job-', l_suppkey)"),
        review_id=F.when(is_open, F.expr("concat(l_orderkey, '-', l_linenumber)")),
        rating=F.when(is_open, F.col("l_quantity")),
        reviews=listed,
    )
    return table(spark, sf_dir, "lineitem").select("l_extendedprice", value.alias("value"))
