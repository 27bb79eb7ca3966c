"""Chat tables: first turns, history budgets and preference rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
HISTORY_BUDGET = 6144
# ----------------------------------------------------------------------------


def first_turn(df: DataFrame, conversation: str = "conversation") -> DataFrame:
    """First exchange of a nested chat row: ``human, assistant``."""
    first = F.get(F.col(conversation), 0)
    rest = [c for c in df.columns if c != conversation]
    return df.select(*rest, first["human"].alias("human"), first["assistant"].alias("assistant"))


def first_turn_by_role(turns: DataFrame, roles: dict[str, str], conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """First message per role of a turn table; ``roles`` maps role to output column.

    Aggregated before the shuffle, so a long conversation is cheap.
    """
    return turns.groupBy(conv).agg(
        *(F.min_by(text, F.when(F.col(role) == r, F.col(turn))).alias(name) for r, name in roles.items())
    )


def exchanges(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """User turns with the assistant turn that directly follows: a join on the turn number."""
    asked = turns.filter(F.col(role) == "user").select(conv, turn, F.col(text).alias("user"))
    replied = turns.filter(F.col(role) == "assistant").select(
        conv, (F.col(turn) - 1).alias(turn), F.col(text).alias("assistant")
    )
    return asked.join(replied, [conv, turn])


def fit_history(
    turns: DataFrame,
    cost: Column,
    budget: int = HISTORY_BUDGET,
    least_cost: int = 1,
    system_cost: Column | int = 0,
    conv: str = "conv_id",
    turn: str = "turn",
) -> DataFrame:
    """Newest exchanges whose running cost, with the system part, stays below the budget.

    A row costs ``least_cost`` at least.  At most budget/least_cost rows of a
    conversation can fit, so older rows are dropped before the shuffle by
    a rank limit; the result is the same and a hot conversation stays bounded.
    """
    newest = Window.partitionBy(conv).orderBy(F.col(turn).desc())
    fitting = max(1, budget // least_cost)
    extra = F.lit(system_cost) if isinstance(system_cost, int) else system_cost
    priced = turns.withColumn("_cost", F.greatest(cost, F.lit(least_cost))).withColumn("_extra", extra)
    near = priced.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= fitting)
    running = F.sum("_cost").over(newest.rowsBetween(Window.unboundedPreceding, 0))
    return (
        near.withColumn("history_cost", running)
        .filter(F.col("history_cost") + F.col("_extra") < budget)
        .drop("_cost", "_extra", "_rank")
    )


def collect_history(fitted: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """``history array<struct<user, assistant>>`` oldest first (bounded by the budget)."""
    ordered = F.sort_array(F.collect_list(F.struct(turn, "user", "assistant")))
    return fitted.groupBy(conv).agg(
        F.transform(
            ordered, lambda t: F.struct(t["user"].alias("user"), t["assistant"].alias("assistant"))
        ).alias("history")
    )
