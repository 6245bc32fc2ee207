"""Frame-time windows and log tails, in batch and as streams.

A window keeps the newest 2048 samples of a session and reports rank-index
percentiles: sorted[n / 2] and sorted[int(0.95 n)].
"""

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

RING = 2048


def frame_class(n, p50, p95):
    return (F.when(n < 8, "too-few-samples").when(p50 > 33.0, "plateau")
            .when((p95 > 50.0) & (p50 <= 20.0), "spikes").otherwise("ok"))


def summarize(sorted_ms):
    """Statistics of an ascending array column of samples."""
    n = F.size(sorted_ms)
    p95 = F.least(F.greatest(F.floor(n * 0.95), F.lit(0)), n - 1).cast("int")
    total = F.aggregate(sorted_ms, F.lit(0.0), lambda a, v: a + v)
    return {"n": n, "min_ms": F.get(sorted_ms, 0), "p50_ms": F.get(sorted_ms, F.floor(n / 2).cast("int")),
            "p95_ms": F.get(sorted_ms, p95), "max_ms": F.get(sorted_ms, n - 1), "mean_ms": total / n}


def frame_time_windows(frames: DataFrame, key, interval="1 second", ring=None) -> DataFrame:
    """Statistics per key and window, over all samples or the newest ``ring``.

    Without a ring equal values are counted within each task first, and ranks
    come from the running counts, so no window's samples form a list. With a
    ring Spark keeps only its rows of each group per task before the shuffle.
    """
    w = F.window(F.col("ts").cast("timestamp"), interval)
    if ring is None:
        counts = frames.withColumn("start", w["start"]).groupBy(key, "start", "ms").agg(F.count(F.lit(1)).alias("c"))
        group = Window.partitionBy(key, "start")
        ranked = counts.withColumn("upto", F.sum("c").over(group.orderBy("ms"))).withColumn("n", F.sum("c").over(group))
        p95 = F.least(F.greatest(F.floor(F.col("n") * 0.95), F.lit(0)), F.col("n") - 1)
        at = [F.min(F.when(F.col("upto") > place, F.col("ms"))).alias(name)
              for place, name in ((F.floor(F.col("n") / 2), "p50_ms"), (p95, "p95_ms"))]
        out = ranked.groupBy(key, "start").agg(F.sum("c").cast("int").alias("n"), F.min("ms").alias("min_ms"), *at, F.max("ms").alias("max_ms"),
                                               (F.sum(F.col("ms") * F.col("c")) / F.sum("c")).alias("mean_ms"))
        return out.withColumn("class", frame_class(F.col("n"), F.col("p50_ms"), F.col("p95_ms")))
    newest = Window.partitionBy(key, "start").orderBy(F.desc("ts"), F.desc("ms"))
    kept = (frames.withColumn("start", w["start"]).withColumn("_rank", F.row_number().over(newest))
            .filter(F.col("_rank") <= ring))
    g = kept.groupBy(key, "start").agg(F.array_sort(F.collect_list("ms")).alias("s"))
    out = g.select(key, "start", *[v.alias(k) for k, v in summarize(F.col("s")).items()])
    return out.withColumn("class", frame_class(F.col("n"), F.col("p50_ms"), F.col("p95_ms")))


STATE = "start timestamp, ts array<timestamp>, ms array<double>"
OUTPUT = "key string, start timestamp, ms array<double>"


def _ring_per_window(width_seconds, ring):
    width = pd.Timedelta(seconds=width_seconds)

    def run(key, batches, state: GroupState):
        name, number = key
        start = pd.Timestamp(number * width_seconds, unit="s")
        if state.hasTimedOut:
            _, _, ms = state.get
            state.remove()
            yield pd.DataFrame({"key": [name], "start": [start], "ms": [sorted(ms)]})
            return
        ts, ms = ([], []) if not state.exists else (list(state.get[1]), list(state.get[2]))
        for rows in batches:
            ts += list(rows["ts"])
            ms += list(rows["ms"])
            newest = sorted(zip(ts, ms), reverse=True)[:ring]
            ts, ms = [t for t, _ in newest], [m for _, m in newest]
        state.update((start.to_pydatetime(), [pd.Timestamp(t).to_pydatetime() for t in ts], [float(m) for m in ms]))
        end = int((start + width).timestamp() * 1000)
        if end > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(end)
    return run


def stream_frame_time_windows(frames: DataFrame, key, seconds=1, late="10 seconds", ring=RING) -> DataFrame:
    """The streaming twin. State per key and window is the ring, never more;
    a window is reported once the watermark passes its end, and rows later
    than the watermark are dropped."""
    keyed = (frames.select(F.col(key).cast("string").alias("key"), F.col("ts").cast("timestamp").alias("ts"), "ms")
             .withWatermark("ts", late)
             .withColumn("number", F.floor(F.unix_micros("ts") / (seconds * 1_000_000)).cast("bigint")))
    rings = keyed.groupBy("key", "number").applyInPandasWithState(
        _ring_per_window(seconds, ring), OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    out = rings.select("key", "start", *[v.alias(k) for k, v in summarize(F.col("ms")).items()])
    return out.withColumn("class", frame_class(F.col("n"), F.col("p50_ms"), F.col("p95_ms")))


def parse_spec_lines(lines: DataFrame) -> DataFrame:
    """Integer fields of each ``parse ... spec=k=v ... t=`` line, as a map."""
    spec = F.regexp_extract("line", r"spec=(.*?)( t=|$)", 1)
    pairs = F.filter(F.split(F.trim(spec), r"\s+"), lambda p: p.rlike("^[^=]+=-?[0-9]+$"))
    fields = F.map_from_entries(F.transform(pairs, lambda p: F.struct(
        F.substring_index(p, "=", 1), F.substring_index(p, "=", -1).cast("int"))))
    return lines.filter(F.col("line").startswith("parse ") & F.col("line").contains("spec=")).withColumn("spec", fields)


def scan_kv_log(lines: DataFrame, source="source_id") -> DataFrame:
    """Fields of the last matching line of each source."""
    parsed = parse_spec_lines(lines)
    return parsed.groupBy(source).agg(F.max("line_no").alias("line_no"), F.max_by("spec", "line_no").alias("spec"))


def log_tail(spark, path: str) -> DataFrame:
    """Parsed fields of the lines that are appended to a file, or to the files of a folder."""
    from .tail import tail_lines
    return parse_spec_lines(tail_lines(spark, path))
