"""Conversations without quotations, in reply order.

A message's lines are parsed into passages by their nested quote marks ('>'). Quoted passages and each of their lines are normalised
and hashed, and joined to the passages and lines that other messages say themselves: first to the latest earlier message of the
conversation, else to the first message anywhere. Links make replies; replies make threads, in whose order a conversation is given.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.textbytes import freed
from foliospark.operators.numbering import numbered
from foliospark.session import table, written

MARKS = re.compile(r"^[ \t]*((?:>[ \t]?)+)(.*)$", re.DOTALL)
#: A line that introduces a quotation and is dropped with it.
INTRODUCTION = re.compile(r"^[ \t]*(?:on .* wrote|am .* schrieb.*|le .* a écrit|el .* escribió)[ \t]*:[ \t]*$", re.IGNORECASE)
NOT_WORD = re.compile(r"[\W_]+")
FAR_CHARS = 12  # of a normalised passage, for it to be looked for in other conversations: shorter ones are said everywhere


def passages(text: str) -> list[tuple[int, str]]:
    """(quote level, passage) in order: consecutive lines of one level; an empty line ends an unquoted passage. Introductions of quotations are left out."""
    out: list[tuple[int, list[str]]] = []
    lines = text.split("\n")
    levels = []
    for line in lines:
        m = MARKS.match(line)
        levels.append((m.group(1).count(">"), m.group(2)) if m else (0, line))
    fresh = True
    for i, (level, body) in enumerate(levels):
        if level == 0 and not body.strip():
            fresh = True
            continue
        if level == 0 and INTRODUCTION.match(body) and any(x > 0 for x, b in levels[i + 1 : i + 3]):
            fresh = True
            continue
        if fresh or not out or out[-1][0] != level:
            out.append((level, []))
        out[-1][1].append(body)
        fresh = False
    return [(level, "\n".join(x).strip()) for level, x in out]


def normalised(passage: str) -> str:
    """Lower-case words with single spaces between them."""
    return NOT_WORD.sub(" ", passage.lower()).strip()


def _hash(passage: str) -> str | None:
    """Of a passage with a letter or digit; those too short to be looked for elsewhere begin with '-'."""
    n = normalised(passage)
    return (hashlib.sha256(n.encode()).hexdigest()[:32] if len(n) >= FAR_CHARS else "-" + hashlib.sha256(n.encode()).hexdigest()[:31]) if n else None


def _hashes(passage: str) -> list[str]:
    """The hash of the whole passage, then those of its lines."""
    return list(dict.fromkeys(h for h in map(_hash, [passage, *passage.split("\n")]) if h))


def parsed_messages(messages: DataFrame) -> DataFrame:
    """messages with body (what they say themselves), said (hashes of its passages, their lines, and the whole) and quoted (level, passage, hash, whole). A null text says nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quoted_type = pa.list_(pa.struct([("level", pa.int32()), ("passage", pa.string()), ("hash", pa.string()), ("whole", pa.bool_())]))
        for batch in batches:
            bodies, said, quoted = [], [], []
            for text in batch.column("text"):
                found = passages(text.as_py() or "")
                own = [p for level, p in found if level == 0 and p]
                bodies.append("\n".join(own))
                said.append(sorted({h for p in [*own, bodies[-1]] for h in _hashes(p)}))
                quoted.append([{"level": level, "passage": hs[0], "hash": h, "whole": h == hs[0]} for level, p in found if level and (hs := _hashes(p)) for h in hs])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "turn", "role")), pa.array(bodies, pa.string()), pa.array(said, pa.list_(pa.string())), pa.array(quoted, quoted_type)],
                ["conv_id", "turn", "role", "body", "said", "quoted"],
            )

    picked = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return picked.mapInArrow(freed(run), "conv_id long, turn long, role string, body string, said array<string>, quoted array<struct<level:int,passage:string,hash:string,whole:boolean>>")


def linked_quotes(parsed: DataFrame) -> DataFrame:
    """conv_id, turn, level, passage, linked_conv, linked_turn: every distinct quoted passage with the message it comes from, or nulls.

    Within a conversation that is the latest earlier message that says it; else, for passages of FAR_CHARS or more, the first (conv_id, turn)
    anywhere but in the message itself and later ones of its conversation. Where nobody says the whole passage, its lines are looked for alike, and the latest
    of the messages in the conversation, else the first elsewhere, has it. Hashes are reduced to one row a conversation turn and one row overall before they are joined, so a
    passage that is said and quoted everywhere makes no pairs.
    """
    quoted = parsed.select("conv_id", "turn", F.explode("quoted").alias("q")).select("conv_id", "turn", "q.*")
    quoted = quoted.groupBy("conv_id", "turn", "passage", "hash").agg(F.min("level").alias("level"), F.max("whole").alias("whole"))
    said = parsed.select("conv_id", "turn", F.explode("said").alias("hash")).join(quoted.select("hash").distinct(), "hash", "left_semi").distinct()
    asked = quoted.select("conv_id", "turn", "hash").distinct()
    timeline = asked.withColumn("asks", F.lit(True)).unionByName(said.select("conv_id", "turn", "hash", F.lit(False).alias("asks")))
    earlier = Window.partitionBy("conv_id", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    here = timeline.withColumn("here", F.max(F.when(~F.col("asks"), F.col("turn"))).over(earlier)).filter("asks").drop("asks")
    # a conversation's own later turns don't answer, so the first two conversations that say a passage are enough
    far = said.filter(~F.col("hash").startswith("-")).groupBy("hash", "conv_id").agg(F.min("turn").alias("t"))
    firsts = far.groupBy("hash").agg(F.min(F.struct("conv_id", "t")).alias("first"), F.max(F.struct("conv_id", "t")).alias("last"))
    joined = here.join(firsts, "hash", "left")
    away = F.when(F.col("first.conv_id") != F.col("conv_id"), F.col("first")).when(F.col("last.conv_id") != F.col("conv_id"), F.col("last"))
    linked = F.when(F.col("here").isNotNull(), F.struct("conv_id", F.col("here").alias("t"))).otherwise(away)
    each = quoted.join(joined.select("conv_id", "turn", "hash", linked.alias("to")), ["conv_id", "turn", "hash"])
    inside = F.col("to.conv_id") == F.col("conv_id")
    rank = F.struct(F.col("whole").cast("int"), inside.cast("int"), F.when(inside, F.col("to.t")).otherwise(-F.col("to.t")), F.when(inside, F.col("to.conv_id")).otherwise(-F.col("to.conv_id")))
    best = each.groupBy("conv_id", "turn", "passage").agg(F.min("level").alias("level"), F.max_by("to", F.when(F.col("to").isNotNull(), rank)).alias("to"))
    return best.select("conv_id", "turn", "level", "passage", F.col("to.conv_id").alias("linked_conv"), F.col("to.t").alias("linked_turn"))


def reply_threads(messages: DataFrame) -> DataFrame:
    """One row for every row of messages (conv_id, turn, role, text; other columns are ignored):

    place (from 1, of the message in its conversation in reply order: thread after thread, replies after what they answer), body (the text without quotations and their introductions), n_quotes (distinct quoted passages), n_linked, quote_depth (deepest level),
    linked_conv and linked_turn (of the shallowest linked passage, the latest of them), reply_to (its turn, if in the conversation),
    thread_root (the turn at the end of the replies) and depth (replies until there). Rows that repeat a (conv_id, turn) share its links, and are joined by all of its texts. Null keys stay and link nothing.
    Replies always go to earlier turns, so threads end; they are followed by doubling, in rounds of the logarithm of the deepest thread.
    """
    parsed = written(parsed_messages(messages), "quotes-parsed")
    quotes = written(linked_quotes(parsed.filter("conv_id is not null and turn is not null")), "quotes-linked")
    order = F.struct(-F.col("level"), (F.col("linked_conv") == F.col("conv_id")).cast("int"), F.col("linked_turn"), F.col("linked_conv"))
    per = quotes.groupBy("conv_id", "turn").agg(
        F.count("*").alias("n_quotes"),
        F.count("linked_turn").alias("n_linked"),
        F.max("level").cast("int").alias("quote_depth"),
        F.max(F.when(F.col("linked_turn").isNotNull(), order)).alias("best"),
    )
    per = per.select("conv_id", "turn", "n_quotes", "n_linked", "quote_depth", F.col("best.linked_conv").alias("linked_conv"), F.col("best.linked_turn").alias("linked_turn"))
    per = per.withColumn("reply_to", F.when(F.col("linked_conv") == F.col("conv_id"), F.col("linked_turn")))
    hops = per.filter("reply_to is not null").select("conv_id", "turn", F.col("reply_to").alias("root"), F.lit(1).cast("long").alias("depth"))
    hops = written(hops, "quotes-hops")
    while True:
        further = hops.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        joined = written(hops.join(further, ["conv_id", "root"], "left"), "quotes-hops")
        hops = joined.select("conv_id", "turn", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        if joined.filter("next is not null").isEmpty():
            break
    out = parsed.drop("said", "quoted").join(per, ["conv_id", "turn"], "left").join(hops, ["conv_id", "turn"], "left")
    zero = lambda c, kind="long": F.coalesce(F.col(c), F.lit(0)).cast(kind).alias(c)
    out = out.withColumn("thread_root", F.coalesce("root", "turn"))
    last = lambda c: F.col(c).asc_nulls_last()
    out = numbered(out, ["conv_id"], [last("thread_root"), last("turn"), last("role"), last("body")])
    return out.select(
        "conv_id", "place", "turn", "role", "body", zero("n_quotes"), zero("n_linked"), zero("quote_depth", "int"), "linked_conv", "linked_turn", "reply_to",
        "thread_root", zero("depth"),
    )


def op7_quote_threads(spark, sf_dir: str) -> DataFrame:
    return reply_threads(table(spark, sf_dir, "conversations"))
