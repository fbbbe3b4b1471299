"""The shared test tables, seen as the relations the operators work on.

The tables hold no recordings, so each relation is bound to a table of the same
shape by a plain projection over all its rows. Nothing is filtered out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import values as v
from ..operators import manifest as mf

# Marks and signs that plain prose lacks; one is appended to every document.
MARKS = (
    " [note] (aside), ok; yes! no?",
    " ga--ni a-b…c:d u᷉ x̵y \"=_/§X ... z",
    " mm... F<a>D ʰʰ◊ mmm… m",
    " @go'ma漢字 X-tA 12 @a'b'c  漢 o'k @'x ɡɡ “q” 。",
    " é à  x y\u001cz ((a) b) c] ḍ̂",
    " fin peu audible",
    " BEGAIEMENT",
    " [a\nb] (c\nd)",
)
LANGUAGES = {"en": "tdh", "fr": "nru", "de": "jya"}

BLOCK_SAMPLES = 64  # one embedding is one block
BLOCK_MS = 4  # at 16 kHz
RECORDING_BLOCKS = 250  # one second


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation nodes: one per conversation turn, some of them unusable."""
    seconds = "concat({0} div 1000, '.', lpad({0} % 1000, 3, '0'))"
    return (
        table(spark, sf_dir, "conversations")
        .selectExpr(
            "conv_id",
            "turn",
            "text",
            "(conv_id * 7 + turn) % 13 as k",
            "turn * 30000 as t0",
            "turn * 30000 + length(text) * 1000 div 64 as t1",
        )
        .selectExpr(
            "format_string('conv%05d', conv_id) as recording",
            "turn as pos",
            "format_string('S%03d', turn + 1) as sent_id",
            """case k when 0 then concat('[note] ', text) when 1 then '[only a note] (aside) !'
               when 2 then concat(text, ' (x), !') when 3 then null
               when 4 then concat(text, ' fin peu audible') else text end as text""",
            f"""case when k in (5, 10) then null when k = 6 then 'x'
                when k = 7 then concat('  ', {seconds.format('t0')}, ' ')
                else {seconds.format('t0')} end as start""",
            f"""case when k = 10 then null when k = 8 then 'nan' when k = 9 then 'inf'
                else {seconds.format('t1')} end as end""",
            """case k when 3 then 'no text' when 10 then 'no audio' when 5 then 'no timecode'
               end as reason""",
        )
    )


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows: ``path, sentence, recording``, one per turn."""
    turns = table(spark, sf_dir, "conversations").selectExpr(
        "format_string('conv%05d', conv_id) as recording",
        "format_string('S%03d', turn + 1) as sent_id",
        "text as sentence",
        "turn",
    )
    return turns.select(
        mf.clip_name(F.col("recording"), F.col("sent_id")).alias("path"),
        "sentence",
        "recording",
        "turn",
    )


def raw_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts: whole documents with marks appended, and a language code."""
    marks = F.array(*map(F.lit, MARKS))
    code = F.create_map(*[F.lit(x) for pair in LANGUAGES.items() for x in pair])
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat("text", F.get(marks, (F.col("doc_id") % len(MARKS)).cast("int"))).alias("text"),
        F.element_at(code, F.col("lang")).alias("language"),
    )


def annotation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation XML written from the paragraphs (or list items) of web pages. The
    sentences of every ninth page have no audio, so its document has no span."""
    void = F.col("page_id") % 9 == 4
    para = F.regexp_extract_all("html", F.lit("<p>([^<]+)</p>"), F.lit(1))
    items = F.regexp_extract_all("html", F.lit("<li>(?:<a[^>]*>)?([^<]+)"), F.lit(1))

    def node(tag: str):
        def element(text, i):
            start, end = i * 10, i * 10 + 5
            audio = (
                F.when((i % 7 == 3) | void, F.lit(""))
                .when(i % 5 == 4, F.concat(F.lit('<AUDIO start="'), start.cast("string"), F.lit('"/>')))
                .otherwise(
                    F.concat(
                        F.lit('<AUDIO start="'), start.cast("string"),
                        F.lit('" end="'), end.cast("string"), F.lit('"/>'),
                    )
                )
            )
            # every sixth node repeats the id of the node before it
            number = F.when(i % 6 == 5, i - 1).otherwise(i)
            form = F.when(i % 11 == 6, F.lit("<FORM/>")).otherwise(
                F.concat(F.lit("<FORM>"), tx.escape_text(text), F.lit("<X>x</X> tail</FORM>"))
            )
            return F.concat(
                F.lit(f'<{tag} id="N'), number.cast("string"), F.lit('">'),
                audio, form, F.lit(f"</{tag}>"),
            )

        return element

    body = F.when(F.size(para) > 0, F.array_join(F.transform(para, node("S")), "")).otherwise(
        F.array_join(F.transform(items, node("W")), "")
    )
    return table(spark, sf_dir, "pages").select(
        v.numbered("page%06d", F.col("page_id")).alias("recording"),
        F.concat(F.lit("<TEXT>"), body, F.lit("</TEXT>")).alias("xml"),
    )


def recording_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory of recordings and other files, one per customer."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        """concat('/corpus/audio/', c_mktsegment, '/',
             case when c_custkey % 10 = 9 then '_tmp' else '' end, c_name,
             case c_custkey % 4 when 0 then '.wav' when 1 then '.WAV' when 2 then '.Wav'
               else '.mp3' end) as path""",
    ).select("c_custkey", "path", v.stem(F.col("path")).alias("stem"))


def annotation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation documents: exact stem, folded stem, both, or none."""
    return (
        table(spark, sf_dir, "customer")
        .selectExpr(
            """explode(case c_custkey % 4 when 0 then array(c_name)
                 when 1 then array(lower(c_name), upper(c_name))
                 when 2 then array(upper(c_name), c_name)
                 else array() end) as stem"""
        )
        .selectExpr("concat('/corpus/xml/', stem, '.xml') as path", "stem")
    )


def small_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, body`` of a tree with a file per 25 embeddings: a top folder, some in it
    and some in those."""
    groups = table(spark, sf_dir, "embeddings").selectExpr("vec_id div 25 as k").distinct()
    return groups.selectExpr(
        """concat(case k % 5 when 0 then '' when 1 then concat('d', k % 7, '/')
             else concat('d', k % 7, '/n', k % 11, '/') end,
             case when k % 7 = 3 then '_tmp' else '' end, 'take', k,
             case k % 4 when 0 then '.wav' when 1 then '.WAV' when 2 then '.xml'
               else '.wav.txt' end) as path""",
        "cast(repeat('x', int(k % 97)) as binary) as body",
    )


def wav_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clip headers with some rates and channel counts out of line."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat(c_name, '.wav') as path",
        "case when c_nationkey % 5 = 0 then 44100 else 16000 end as sr",
        "case when c_custkey % 9 = 0 then 2 else 1 end as channels",
    )


def frame_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model output: an utterance of 8 frames of 8 class scores per embedding."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id as utt",
        "transform(sequence(0, 7), f -> slice(embedding, f * 8 + 1, 8)) as frames",
    )


FRAME_CHARS = ("a", "b", "c", "d", "e", "|", "[UNK]", "[PAD]")


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample blocks: 64 samples per embedding, 250 blocks per recording."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        f"format_string('rec%05d', vec_id div {RECORDING_BLOCKS}) as recording",
        f"vec_id % {RECORDING_BLOCKS} as block_no",
        """transform(embedding, x -> cast(greatest(least(floor(double(x) * 32767), 32767), -32768)
             as smallint)) as samples""",
    )


def block_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans over the sample blocks, one starting in every block."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        f"format_string('rec%05d', vec_id div {RECORDING_BLOCKS}) as recording",
        "format_string('clip%07d.wav', vec_id) as path",
        f"(vec_id % {RECORDING_BLOCKS} * 4 + 0.5D) / 1000.0D as start_s",
        f"(vec_id % {RECORDING_BLOCKS} * 4 + 5 + vec_id % 23) / 1000.0D as end_s",
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference and hypothesis: a turn and the turn after it, whole texts. Both
    sides are the whole table, so this is a shuffled join; scoring is the heavy
    part, and runs in parallel after the shuffle."""
    turns = table(spark, sf_dir, "conversations")
    after = turns.selectExpr("conv_id", "turn - 1 as turn", "text as hypothesis")
    return (
        turns.selectExpr("conv_id", "turn", "role", "text as reference")
        .join(after.hint("merge"), ["conv_id", "turn"])
    )


def chunk_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcribed chunks: a recording per user, chunks in event order. Some
    predictions are empty, missing or awkward."""
    return table(spark, sf_dir, "events").selectExpr(
        "format_string('rec%05d', user_id) as recording",
        "event_id as chunk_no",
        "cast(round(value * 100) as bigint) as length_ms",
        """case when event_id % 7 = 0 then '' when event_id % 11 = 0 then null
             when event_id % 13 = 0 then ' ' when event_id % 17 = 0 then 'NA'
             when event_id % 19 = 0 then concat(event_type, '  <', props, '> & "x"')
             else concat(event_type, ' ', props) end as prediction""",
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training history: a run per user, evaluations in event order."""
    return table(spark, sf_dir, "events").selectExpr(
        "user_id as run", "event_id as step", "value as wer"
    )


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "user_id as run", "concat('checkpoint-', event_id) as name"
    )


def pcm_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample blocks as little-endian 16-bit PCM bytes."""
    swapped = "transform(samples, x -> lpad(hex(pmod(int(x), 65536)), 4, '0'))"
    return blocks(spark, sf_dir).selectExpr(
        "recording",
        "block_no",
        f"""unhex(array_join(transform({swapped}, h -> concat(substr(h, 3, 2), substr(h, 1, 2))), ''))
             as data""",
    )


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded rows: a value per character as input, a label per word."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id * 100000 + turn as utt",
        """transform(filter(split(text, ''), c -> c <> ''), c -> ascii(c) / 128.0D)
             as input_values""",
        "transform(filter(split(text, ' '), w -> w <> ''), w -> length(w)) as labels",
    )


def labelled_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips of the sample blocks with a sentence: one starting in every block."""
    named = table(spark, sf_dir, "embeddings").selectExpr(
        "format_string('clip%07d.wav', vec_id) as path",
        """concat(array('fin', 'mot à mot', 'so say')[int(vec_id % 3)], ' ', vec_id, ' ',
             coalesce(label, -1)) as sentence""",
    )
    windows = mf.clip_windows(block_spans(spark, sf_dir), tail=0.002)
    return named.join(windows.drop("start_s", "end_s"), "path")
