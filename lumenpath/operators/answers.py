"""What a user answered, as one text per attempt and activity.

Each text is as long as the answers it holds, so the aggregation key is an attempt and an
activity, never anything coarser; duplicate rows are folded before they are collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.functions import codes
from lumenpath.functions.exprs import join_sorted
from lumenpath.operators.sizes import dealt
from lumenpath.sources import Platform


TEXT_KEYS = ("attempt_id", "activity_id", "tenant_id")


def choice_answers(platform: Platform, dealt_by: Sequence[str] = TEXT_KEYS) -> DataFrame:
    """Correctly chosen, active alternatives in choice order.

    ``dealt_by`` names the keys by which the rows travel: those of the next join or grouping, which then needs no exchange.
    """
    choices = platform.choices.where("is_active").select("choice_id", "activity_id", "tenant_id", "text")
    picked = platform.choice_answers.where("is_correct").select("attempt_id", "activity_id", "choice_id", "tenant_id")
    picked = picked.join(choices, ["choice_id", "activity_id", "tenant_id"])
    return dealt(picked, dealt_by).groupBy(*TEXT_KEYS).agg(
        join_sorted(["choice_id"], "text").alias("choice_text")
    )


def form_answers(platform: Platform, dealt_by: Sequence[str] = TEXT_KEYS) -> DataFrame:
    """Per question: chosen alternative, free text and scale; then all questions of the form in order."""
    questions = platform.form_questions.where("is_active").select("question_id", "activity_id", "tenant_id")
    written = platform.form_answers.select("question_id", "attempt_id", "tenant_id", "essay_text", "scale")
    ticked = (
        platform.form_choice_answers.where("is_selected").select("question_id", "attempt_id", "choice_id", "tenant_id")
        .join(platform.form_choices.select("choice_id", "tenant_id", F.col("text").alias("choice")), ["choice_id", "tenant_id"])
    )
    pieces = (
        written.join(ticked, ["question_id", "attempt_id", "tenant_id"], "full")
        .join(questions, ["question_id", "tenant_id"])
        .withColumn("text", F.concat_ws(", ", "choice", "essay_text", F.col("scale").cast("string")))
    )
    return dealt(pieces, dealt_by).groupBy(*TEXT_KEYS).agg(
        join_sorted(["question_id", "choice_id"], "text").alias("form_text")
    )


def minigame_answers(platform: Platform) -> DataFrame:
    """Selected, active mini-game alternatives of an attempt in choice order."""
    keys = ["attempt_id", "question_id", "tenant_id"]
    picked = platform.minigame_choice_answers.where("is_selected").select(*keys, "choice_id")
    names = platform.minigame_choices.where("is_active").select("choice_id", "tenant_id", "text")
    return (
        platform.minigame_answers.select(*keys)
        .join(picked, keys, "left")
        .join(names, ["choice_id", "tenant_id"], "left")
        .groupBy("attempt_id", "tenant_id")
        .agg(join_sorted(["question_id", "choice_id"], "text").alias("minigame_text"))
    )


def answer_text():
    """The answer that fits the activity type."""
    kind = F.col("activity_type_id")
    return (
        F.when(kind.isin(*codes.CHOICE_TYPES), F.col("choice_text"))
        .when(kind.isin(*codes.ESSAY_TYPES), F.col("essay_text"))
        .when(kind == codes.FORM_TYPE, F.col("form_text"))
        .when(kind == codes.MINIGAME_TYPE, F.col("minigame_text"))
    )
