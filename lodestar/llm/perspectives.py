"""Dialogues rendered once per participant (operator 10).

For every participant of a conversation the whole dialogue is rendered with
that speaker as the assistant, the others as named users and system turns as
they are; the loss masks cover what the assistant says.  A dialogue is cut into
parts of PART_TURNS turn numbers, each a row with its offset in the whole, so a long
conversation with ascending turn numbers is not gathered into one task.  The SQL of the
query cuts by turn number: turns without a number or with few different ones are
one part, one row and one task, whose work is linear in its turns.
Column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART_TURNS = 256
SYSTEM = "system"
UNNAMED = "unknown"
OWN = "<|assistant|>\n"


def user(role: Column) -> Column:
    return F.concat(F.lit("<|user name="), F.coalesce(role, F.lit(UNNAMED)), F.lit("|>\n"))


def rotate(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, participant, part int, n_turns int, char_start long, text, masks`` for every
    participant (role other than ``system``) of ``conversations(conv_id, turn, role, text)``.

    A turn is ``<|system|>``, ``<|assistant|>`` or ``<|user name=ROLE|>``, a line break, the text,
    ``<|end|>`` and a line break.  ``masks`` are the half-open ranges of characters, counted from
    the start of the part, of the assistant's texts with their end marks; ``char_start`` is the
    part's offset in the whole dialogue.  Turns come in the order of (turn, role, text), null
    turn numbers first (part 0); a null text is empty; a null role is a user named ``unknown``, no
    participant; turns with a null conv_id form one conversation; repeated rows are
    repeated turns; a conversation without participants gives no rows.
    """
    turns = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("said"))
    turns = turns.withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(0)).cast("int"))
    people = (turns.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("role").alias("participant")).distinct())
    # Places are counted with every speaker as a user; a participant's own labels shift them by the same
    # length at each own turn before, so the masks need no running sum per participant.
    plain = F.when(F.col("role") == SYSTEM, "<|system|>\n").otherwise(user(F.col("role")))
    ahead = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "said").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("at", F.coalesce(F.sum((F.length(plain) + F.length("said") + 8).cast("long")).over(ahead), F.lit(0)))
    parts = (placed.groupBy("conv_id", "part")
             .agg(F.array_sort(F.collect_list(F.struct("at", "role", "said"))).alias("turns")))
    seen = parts.join(people, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")

    def label(t):
        return (F.when(t["role"] == SYSTEM, "<|system|>\n").when(t["role"] == F.col("participant"), OWN)
                .otherwise(user(t["role"])))

    lines = F.transform("turns", lambda t: F.concat(label(t), t["said"], F.lit("<|end|>\n")))
    shift = F.lit(len(OWN)) - F.length(user(F.col("participant")))

    def mask(t, i):
        start = t["at"] + i * shift + len(OWN)
        return F.struct(start.cast("int").alias("start"), (start + F.length(t["said"]) + 7).cast("int").alias("end"))

    rendered = seen.select(
        "conv_id", "participant", "part", F.size("turns").alias("n_turns"), F.array_join(lines, "").alias("text"),
        F.transform(F.filter("turns", lambda t: t["role"] == F.col("participant")), mask).alias("masks"))
    before = Window.partitionBy("conv_id", "participant").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (turns.join(people, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
              .groupBy("conv_id", "participant", "part")
              .agg(F.sum((F.length(label({"role": F.col("role")})) + F.length("said") + 8).cast("long")).alias("n"))
              .select(F.col("conv_id").alias("c"), F.col("participant").alias("p"), F.col("part").alias("k"),
                      F.coalesce(F.sum("n").over(before), F.lit(0)).alias("char_start")))
    return (rendered.join(starts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("participant") == F.col("p")) & (F.col("part") == F.col("k")))
            .select("conv_id", "participant", "part", "n_turns", "char_start", "text", "masks"))
