"""One recording holds a third of the rows: its rows must not meet in one task."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from wavs import write_wav

from speechprep.operators import documents, running, split, timeline
from speechprep.operators.lookup import lookup
from speechprep.session import spread
from speechprep.sources import audio, files

ROWS, PARTITIONS = 60_000, 12


@pytest.fixture(autouse=True)
def plain_shuffles(spark):
    """Fixed partitions and no broadcast, as for tables too large for either."""
    settings = {
        "spark.sql.shuffle.partitions": str(PARTITIONS),
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, value in settings.items():
        spark.conf.set(k, value)
    yield
    for k, value in before.items():
        spark.conf.set(k, value)


def hot(spark):
    return spark.range(ROWS).selectExpr(
        "if(id % 3 = 0, 'hot', concat('r', id % 500)) as recording",
        "id as chunk_no",
        "id % 3000 + 1 as length_ms",
        "concat('word ', id) as prediction",
        "concat('r', id, '_S', id, '.wav') as path",
    )


def largest_share(df, weight=None):
    """Largest part of all rows (or of a weight) that one task holds."""
    weight = F.lit(1) if weight is None else weight
    needed = F.max(F.xxhash64(*df.columns))  # or the optimizer drops what is unused
    per_task = df.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(weight).alias("n"), needed)
    sizes = [r.n for r in per_task.collect()]
    return max(sizes) / sum(sizes)


def test_the_data_is_skewed(spark):
    assert largest_share(hot(spark).repartition("recording")) > 1 / 3


def test_running_sums(spark):
    summed = running.before(
        hot(spark), ["recording"], "chunk_no", {"s": ("sum", F.col("length_ms"))}, 1_000
    )
    assert largest_share(summed) < 0.2
    expected, total = {}, Counter()
    for r in hot(spark).orderBy("chunk_no").collect():
        expected[r.chunk_no] = total[r.recording]
        total[r.recording] += r.length_ms
    assert {r.chunk_no: r.s for r in summed.collect()} == expected


def test_document_parts(spark):
    timed = timeline.timeline(hot(spark), "length_ms", 1000, 1_000)
    parts = documents.tier_xml(
        timed, timed.select("recording").distinct(), "tdh", "now", part=1_000
    )
    assert largest_share(parts, F.length("body")) < 0.2
    whole = parts.filter("recording = 'hot' and section = 3")
    assert whole.count() == 60


def test_lookup(spark):
    facts = spark.range(500).selectExpr("concat('r', id) as recording", "id as fact").unionByName(
        spark.sql("select 'hot' as recording, -1L as fact")
    )
    found = lookup(hot(spark), facts, "recording", ["path"])
    assert largest_share(found) < 0.2
    assert found.count() == ROWS
    wrong = found.filter("fact <> if(recording = 'hot', -1, cast(substr(recording, 2) as bigint))")
    assert wrong.count() == 0
    rest = lookup(hot(spark), facts.filter("fact >= 0"), "recording", ["path"], "left_anti")
    assert {r.recording for r in rest.select("recording").distinct().collect()} == {"hot"}


def test_split_leaves_clips_where_they_are(spark):
    clips = hot(spark).repartition(PARTITIONS)
    assert largest_share(split.assign_splits(clips, key="recording")) < 0.1


def test_one_long_file_is_read_by_all_tasks(spark, tmp_path):
    write_wav(tmp_path / "long.wav", [np.zeros(8_000 * 60 * 40)], 8_000)
    headers = audio.read_headers(files.scan_recordings(spark, str(tmp_path)))
    blocks = audio.read_blocks(headers, rate=8_000)
    assert blocks.count() == 2_400
    assert largest_share(blocks) < 0.35
    assert spread(spark.range(100), "id").rdd.getNumPartitions() == PARTITIONS
