"""The page's numbers come from one computation of the events."""

from pyspark.sql import functions as F

from shapelog.sources import sinks


def test_events_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def see(x):
        seen.add(1)
        return x

    action = F.udf(see, "string").asNondeterministic()(F.lit("deny"))
    lineage = F.struct(F.lit("/a").alias("source_path"), F.col("id").alias("line_number"))
    texts = [F.lit(v).alias(k) for k, v in {"timestamp": "2024-01-01T00:00:00.000Z", "vendor": "v", "source_format": "json", "src_ip": "1.2.3.4", "dst_ip": "1.2.3.5"}.items()]
    rows = spark.range(40).select(*texts, action.alias("action"), F.lit(0.9).alias("confidence"), lineage.alias("lineage"))
    page = sinks.dashboard(rows)
    assert "<b>40</b>" in page and "<b>100.0%</b>" in page and page.count("<tr>") > 25
    assert seen.value == 40
