"""Preference formatting: one prompt and two masked completions of a pair of conversations.

Of the chosen and the rejected conversation the longest common prefix of turns is
rendered once as the prompt. The rest of either is its completion, with the spans
a loss may look at: the replies of the assistant with their end marks.

Conversations are the unit of the output, so the turns of one meet in one row. The
length of the common prefix and the spans come from array expressions on that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import fresh, stored
from spendlens.plans.skew import hot_keys, lookup

# The marks of the chat template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"

#: The role whose turns are learnt.
LEARNT = "assistant"

_TURNS = "array<struct<role:string,text:string>>"


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id`` and its ``turns`` (role, text) in order, from one row per turn.

    Rows without a conversation id belong to none and are left out. Turns are
    ordered by number, then role, then text, null first; a row given twice counts
    once. A null role is "unknown" and a null text is empty.
    """
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = F.array_sort(F.collect_set(turn))
    return (
        turns.where(F.col("conv_id").isNotNull())
        .groupBy("conv_id")
        .agg(F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    )


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"), turn["text"], F.lit(CLOSE))


def _common_prefix(chosen: Column, rejected: Column) -> Column:
    """Number of leading turns that are equal in both."""
    both = F.least(F.size(chosen), F.size(rejected))
    differ = F.array_position(
        F.transform(
            F.slice(chosen, 1, both),
            lambda turn, i: turn.eqNullSafe(rejected[i]),
        ),
        False,
    )
    return F.when(differ > 0, differ.cast("int") - 1).otherwise(both)


#: Turns whose lengths are summed at a time.
_BLOCK = 256


def _head(turn: Column) -> Column:
    return F.length(F.concat(F.lit(OPEN), turn["role"], F.lit("\n")))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda total, x: total + x)


def _with_loss_spans(df: DataFrame, completion: str, spans: str) -> DataFrame:
    """Where in the rendered completion the learnt replies and their end marks are.

    A turn starts where all blocks of turns before its own and the turns before it in its
    block end, so the work grows with the turns and not with their square.
    """
    sizes, blocks, before = fresh(df, "_sizes", "_blocks", "_before")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    whole = F.lit(_BLOCK)
    sized = df.withColumn(sizes, F.transform(completion, lambda t: F.length(rendered(t)).cast("bigint")))
    numbers = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / whole).cast("int"))
    summed = sized.withColumn(
        blocks, F.transform(numbers, lambda b: _sum(F.slice(sizes, b * whole + 1, whole)))
    ).withColumn(before, F.transform(blocks, lambda x, b: _sum(F.slice(blocks, F.lit(1), b))))

    def span(turn: Column, i: Column) -> Column:
        block = F.floor(i / whole).cast("int")
        start = F.get(before, block) + _sum(F.slice(sizes, block * whole + 1, i % whole))
        return F.struct(
            turn["role"].alias("role"), (start + _head(turn)).alias("start"), (start + F.get(sizes, i)).alias("end")
        )

    learnt = F.filter(F.transform(completion, span), lambda s: s["role"] == LEARNT)
    bare = F.transform(learnt, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return summed.withColumn(spans, F.when(F.size(sizes) > 0, bare).otherwise(none)).drop(sizes, blocks, before)


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``pairs`` with the prompt and the two masked completions of its conversations.

    ``chosen`` and ``rejected`` are arrays of (role, text); null is no turns. They are
    replaced by ``n_prompt_turns``, ``prompt``, ``chosen_completion``,
    ``chosen_spans``, ``rejected_completion``, ``rejected_spans`` (character ranges,
    end exclusive) and ``usable``: both completions hold a learnt reply and they
    differ. Where one conversation begins the other, or both are equal, a completion is
    empty. Rows stay as they are, repeated or not; columns with an output's
    name are replaced.
    """
    outputs = ("n_prompt_turns", "prompt", "chosen_completion", "chosen_spans",
               "rejected_completion", "rejected_spans", "usable")
    taken = {n.lower() for n in (*outputs, chosen, rejected)}
    kept = [c for c in pairs.columns if c.lower() not in taken]
    a, b, n = fresh(pairs, "_a", "_b", "_n")
    none = F.array().cast(_TURNS)
    sides = pairs.select(
        *kept,
        F.coalesce(F.col(chosen).cast(_TURNS), none).alias(a),
        F.coalesce(F.col(rejected).cast(_TURNS), none).alias(b),
    ).withColumn(n, _common_prefix(F.col(a), F.col(b)))

    def text(turns: Column) -> Column:
        return F.array_join(F.transform(turns, rendered), "")

    def rest(side: str) -> Column:
        return F.slice(side, F.col(n) + 1, F.greatest(F.lit(0), F.size(side) - F.col(n)))

    c, r = fresh(sides, "_chosen", "_rejected")
    rests = sides.withColumn(c, rest(a)).withColumn(r, rest(b))
    for completion, spans in ((c, "chosen_spans"), (r, "rejected_spans")):
        rests = _with_loss_spans(rests, completion, spans)
    formatted = rests.select(
        *kept,
        F.col(n).cast("bigint").alias("n_prompt_turns"),
        text(F.slice(a, F.lit(1), F.col(n))).alias("prompt"),
        text(F.col(c)).alias("chosen_completion"),
        "chosen_spans",
        text(F.col(r)).alias("rejected_completion"),
        "rejected_spans",
    )
    return formatted.withColumn(
        "usable",
        (F.size("chosen_spans") > 0) & (F.size("rejected_spans") > 0)
        & (F.col("chosen_completion") != F.col("rejected_completion")),
    )


def stale_reply(turns: Column) -> Column:
    """A worse variant: the last assistant reply gives the reply before it again, or nothing."""
    replies = F.filter(
        F.transform(turns, lambda t, i: F.struct(i.alias("i"), t["role"].alias("role"), t["text"].alias("text"))),
        lambda t: t["role"] == LEARNT,
    )
    n = F.size(replies)
    last = F.when(n > 0, replies[n - 1]["i"]).otherwise(-1)
    before = F.when(n > 1, replies[n - 2]["text"]).otherwise("")
    return F.transform(
        turns,
        lambda t, i: F.struct(
            t["role"].alias("role"), F.when(i == last, before).otherwise(t["text"]).alias("text")
        ),
    )


def paired_by_opening(turns: DataFrame) -> DataFrame:
    """One pair per conversation: itself as chosen, and a conversation with the same first turn.

    Conversations of the same turns are one: no partner is a copy of its conversation.
    The partner is the conversation of the smallest id with that opening. That one and
    its copies take the largest id, or where that is one of them the largest of the
    first ids of the distinct conversations. ``partner_id`` is null where nothing but copies
    has the opening, and the rejected side is then the conversation with a stale last reply.

    Partners come from minima and maxima per opening, so no pair is made beside these. The
    partners' turns go to the conversations once per opening; an opening that very many
    begin with is split over as many tasks as it has shares.
    """
    # Written out once: several uses read it.
    talks = stored(
        conversations(turns)
        .withColumn("opening", F.sha2(rendered(F.col("turns")[0]), 256))
        .withColumn("whole", F.sha2(F.array_join(F.transform("turns", rendered), ""), 256)),
        "conversations",
    )
    distinct = talks.groupBy("opening", "whole").agg(
        F.min("conv_id").alias("first"), F.max("conv_id").alias("last"), F.count(F.lit(1)).alias("n")
    )
    openings = stored(
        distinct.groupBy("opening").agg(
            F.min(F.struct("first", "whole")).alias("low"),
            F.max(F.struct("last", "whole")).alias("high"),
            F.max("first").alias("other"),
            F.sum("n").alias("n"),
        ),
        "openings",
    )
    shared = openings.where(F.col("low.first") != F.col("other")).select(
        "opening",
        F.col("low.whole").alias("head"),
        F.col("low.first").alias("first"),
        F.when(F.col("high.whole") != F.col("low.whole"), F.col("high.last"))
        .otherwise(F.col("other")).alias("last"),
    )

    def held_by(side: str) -> DataFrame:
        return talks.select(F.col("conv_id").alias(side), F.col("turns").alias(f"{side}_turns"))

    partners = stored(shared.join(held_by("first"), "first").join(held_by("last"), "last"), "partners")
    met = lookup(
        talks, partners.withColumn("known", F.lit(True)), "opening", hot_keys(openings, "opening", "n"), "conv_id"
    )
    own_head = F.col("whole") == F.col("head")
    known = F.coalesce("known", F.lit(False))
    return met.select(
        "conv_id",
        F.when(known, F.when(own_head, F.col("last")).otherwise(F.col("first"))).alias("partner_id"),
        F.col("turns").alias("chosen"),
        F.when(known, F.when(own_head, F.col("last_turns")).otherwise(F.col("first_turns")))
        .otherwise(stale_reply(F.col("turns"))).alias("rejected"),
    )
