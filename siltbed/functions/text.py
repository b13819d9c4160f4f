"""Text cleaning with built-in functions only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from siltbed.fixed_values import (
    CAMEL_CASE_BOUNDARY,
    MATTER_ANSWER_PATTERN,
    MATTER_QUESTION,
    USER_ANSWER_PATTERN,
    USER_QUESTIONS,
    WORK_TYPE_MARK,
    WORK_TYPE_PATTERN,
)

TAG = "<.*?>"
TAG_ACROSS_LINES = "<[^>]*+>"


def without_html(text: Column, dotall: bool = False) -> Column:
    no_tags = F.regexp_replace(text, TAG_ACROSS_LINES if dotall else TAG, "")
    return F.trim(F.regexp_replace(no_tags, "&nbsp;?", " "))


def strip_html(df: DataFrame, columns: Iterable[str], dotall: bool = False) -> DataFrame:
    """Remove tags and ``&nbsp`` from ``columns`` and trim them.

    A tag that spans lines is kept unless ``dotall`` is set.
    """
    return df.withColumns({c: without_html(F.col(c), dotall) for c in columns})


def split_camel_case(text: Column | str) -> Column:
    return F.regexp_replace(text, CAMEL_CASE_BOUNDARY, " ")


def form_answer_values(df: DataFrame, target: str = "AnswerIntegerValue") -> DataFrame:
    """Derive the value behind a form answer from its question's rule.

    A rule that applies without matching gives an empty string; a question
    without a rule gives null. The work type rule outranks the other two.
    """
    question, answer = F.col("QuestionName"), F.col("AnswerValue")
    work_type = F.regexp_extract(question, WORK_TYPE_PATTERN, 1)
    searched = F.col("AnswerSearchValue") != "null"
    value = (
        F.when(
            question.contains(WORK_TYPE_MARK),
            split_camel_case(F.translate(work_type, "_", " ")),
        )
        .when(
            (question == MATTER_QUESTION) & searched,
            F.regexp_extract(answer, MATTER_ANSWER_PATTERN, 1),
        )
        .when(
            question.isin(*USER_QUESTIONS), F.regexp_extract(answer, USER_ANSWER_PATTERN, 2)
        )
    )
    return df.withColumn(target, value)
