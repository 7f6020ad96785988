"""Chat formatting of reply trees.

Messages point to the message they reply to. Iterative self-joins with doubling steps (1, 2,
4, ... replies up) find every message's depth, root and the summed score of its path in as many
rounds as the logarithm of the deepest reply. Leaves are the branches: they are ranked by mean
score inside their conversation, and only the chosen ones are walked back to the root, again by
doubling. Each chosen path becomes one conversation, one formatted segment a message.

Template of a message:  ``### <role>: <text></turn>\n``. In roles and texts a backslash, ``#``,
``<`` and ``:`` (roles only) that could start or end a mark gets a backslash before it, so no
mark occurs inside them and removing one backslash from each pair restores them.

Null text or role: empty. A message without id, or whose parent is missing, is a root. Equal
ids are one message each as far as they can be told apart, so ids must be unique: give
:func:`linear_replies` rows without ids. Replies in a ring have no root and are left out.
Empty input gives no conversation. Only the named columns are read, so others can't clash. Very
long texts are escaped and digested whole, one message at a time.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import map_arrow, table, written

HEAD, COLON, END = "### ", ": ", "</turn>\n"     # marks of a turn
ASSISTANT = "assistant"                          # whose texts are under the loss mask

_TURN = re.compile(r"### ((?:[^\\:]|\\.)*?): ((?:[^\\<]|\\.)*?)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text):
    """Column with a backslash before each backslash, ``#`` and ``<``."""
    return F.regexp_replace(text, r"([\\#<])", r"\\$1")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def linear_replies(turns: DataFrame) -> DataFrame:
    """Messages of conversations without branches: each row replies to the one before it.

    ``turns``: conv_id, turn, role, text. Rows with the same turn follow each other in order
    of role and text. Rows get their place in the conversation as id, from 0 on.
    """
    key = ["conv_id", "turn", "role", "text"]
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Dealt by range, so that a conversation of any size is numbered by many tasks: places inside
    # a range, after the rows that the conversation has in earlier ranges.
    d = written(turns.select(*key).repartitionByRange(n, *key).withColumn("range", F.spark_partition_id()), "chat-order")
    sizes = d.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("conv_id").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(F.col("conv_id").alias("c"), F.col("range").alias("r"),
                         F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = W.partitionBy("range", "conv_id").orderBy("turn", "role", "text")
    d = d.withColumn("place", F.row_number().over(inside) - 1).join(
        sizes, (F.col("range") == F.col("r")) & F.col("conv_id").eqNullSafe(F.col("c")))
    d = d.select("conv_id", "role", "text", (F.col("place") + F.col("offset")).cast("long").alias("id"))
    return d.select("conv_id", "id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"),
                    "role", "text", F.lit(1.0).alias("score"))


def branches(messages: DataFrame) -> DataFrame:
    """conv_id, leaf, depth, score (mean along the path) of each root-to-leaf path.

    ``messages``: conv_id, id, parent, score.
    """
    d = messages.select("conv_id", "id", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    parents = d.select(F.col("conv_id").alias("c"), F.col("id").alias("p")).distinct()
    d = d.join(parents, d["conv_id"].eqNullSafe(F.col("c")) & (F.col("parent") == F.col("p")), "left")
    state = written(d.select("conv_id", "id", F.col("p").alias("up"), F.lit(1).alias("depth"), "score"),
                    "chat-up")
    leaf_of = state.select(F.col("conv_id").alias("c"), F.col("up").alias("p")).where("p IS NOT NULL").distinct()
    # Each round looks twice as far up: up is the message 2^k replies above, null past the root.
    while state.where("up IS NOT NULL").limit(1).count():
        above = state.select(F.col("conv_id").alias("c"), F.col("id").alias("i"), F.col("up").alias("up2"),
                             F.col("depth").alias("d2"), F.col("score").alias("s2"))
        # Messages that have reached their root are left as they are.
        under = state.where("up IS NOT NULL")
        new = under.join(above, under["conv_id"].eqNullSafe(F.col("c")) & (F.col("up") == F.col("i"))).select(
            "conv_id", "id", F.col("up2").alias("up"), (F.col("depth") + F.col("d2")).alias("depth"),
            (F.col("score") + F.col("s2")).alias("score"))
        new = written(new.unionByName(state.where("up IS NULL")), "chat-up")
        if new.agg(F.max("depth")).first()[0] > RING_DEPTH:
            raise ValueError("replies form a ring")
        state = new
    leaves = state.join(leaf_of, state["conv_id"].eqNullSafe(F.col("c")) & (F.col("id") == F.col("p")), "left_anti")
    return leaves.select("conv_id", F.col("id").alias("leaf"), "depth", (F.col("score") / F.col("depth")).alias("score"))


RING_DEPTH = 1 << 30       # a path longer than this is a ring


def chosen_paths(messages: DataFrame, best: int | None = None) -> DataFrame:
    """conv_id, leaf, rank, place, id: the messages of each chosen path, root first.

    ``best``: paths kept of each conversation, by falling mean score, then depth and leaf;
    None keeps all.
    """
    ends = branches(messages)
    order = W.partitionBy("conv_id").orderBy(F.desc("score"), F.desc("depth"), "leaf")
    ends = ends.withColumn("rank", F.row_number().over(order))
    if best is not None:
        ends = ends.where(F.col("rank") <= best)
    jump = messages.select(F.col("conv_id").alias("c"), F.col("id").alias("i"), F.col("parent").alias("up"))
    path = written(ends.select("conv_id", "leaf", "rank", "depth", F.col("leaf").alias("id"),
                               F.lit(0).alias("above")), "chat-path")
    deepest = path.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    step = 1
    while step < deepest:
        # Every message found so far leads to the one ``step`` replies above it.
        more = path.join(jump, path["conv_id"].eqNullSafe(F.col("c")) & (F.col("id") == F.col("i")))
        more = more.where((F.col("above") + step) < F.col("depth")).select(
            "conv_id", "leaf", "rank", "depth", F.col("up").alias("id"), (F.col("above") + step).alias("above"))
        path = written(path.union(more), "chat-path")
        if 2 * step < deepest:
            far = jump.select(F.col("c").alias("c2"), F.col("i").alias("i2"), F.col("up").alias("up2"))
            jump = written(jump.join(far, F.col("c").eqNullSafe(F.col("c2")) & (F.col("up") == F.col("i2")))
                           .select("c", "i", F.col("up2").alias("up")), "chat-jump")
        step *= 2
    return path.select("conv_id", "leaf", "rank", (F.col("depth") - 1 - F.col("above")).alias("place"), "id")


def format_paths(messages: DataFrame, best: int | None = None) -> DataFrame:
    """conv_id, rank, place, segment, loss_start, loss_end of each message of the chosen paths.

    The conversation is the segments of a (conv_id, rank) in order of place, end to end. The
    loss mask covers code points loss_start .. loss_end - 1 of the segment (none where equal).
    """
    m = messages.select(F.col("conv_id").alias("c"), F.col("id").alias("i"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    p = chosen_paths(messages, best)
    d = p.join(m, p["conv_id"].eqNullSafe(F.col("c")) & (F.col("id") == F.col("i")))
    head = F.concat(F.lit(HEAD), F.regexp_replace("role", r"([\\#<:])", r"\\$1"), F.lit(COLON))
    body = escape("text")
    start = F.length(head)
    masked = F.col("role") == ASSISTANT
    return d.select("conv_id", "rank", "place", F.concat(head, body, F.lit(END)).alias("segment"),
                    start.alias("loss_start"), F.when(masked, start + F.length(body)).otherwise(start).alias("loss_end"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, rank, n_turns and digests of what the formatted conversations say.

    A task reads the segments of its conversations in order and keeps running digests, so a
    conversation of any length takes the memory of one message.
    """
    schema = T.StructType([f for f in formatted.schema if f.name in ("conv_id", "rank")] + [
        T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType())])
    names = ["conv_id", "rank", "segment", "loss_start", "loss_end"]
    arrow = to_arrow_schema(schema)

    def run(batches):
        key, state = None, None

        def result():
            n, turns, chars, loss, size = state
            return [*key, n, turns.hexdigest(), chars, loss.hexdigest(), size]

        done: list[list] = []
        for batch in batches:
            for conv, rank, segment, lo, hi in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist()
                                                      for n in names)):
                if key != (conv, rank):
                    if key is not None:
                        done.append(result())
                    key, state = (conv, rank), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                m = _TURN.fullmatch(segment)
                role, text = unescape(m[1]), unescape(m[2])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                masked = unescape(segment[lo:hi])
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(segment)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], arrow.names)
                done = []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(result()), arrow)], arrow.names)

    ordered = (formatted.select(*names, "place").repartition("conv_id", "rank")
               .sortWithinPartitions("conv_id", "rank", "place"))
    return map_arrow(ordered, run, schema)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of control strings, formatted and read back."""
    own = "\\### Assistant: </turn> ok"
    d = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], d.schema)
    messages = written(linear_replies(d.unionByName(extra)), "chat-messages")
    return read_back(format_paths(messages)).drop("rank")


#: The template's marks take 14 code points a turn; each escaped code point takes one more.
OP7_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role AS r, text AS t, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, turn, role, text, role, text
  FROM (SELECT unnest([0, 1]) AS turn, unnest(['user', 'assistant']) AS role, '\### Assistant: </turn> ok' AS text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(14 + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g'))
                + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""
