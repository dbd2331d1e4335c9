"""Prompt building and projections.

Per-row string expressions: no shuffle, valid on streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zero-shot reasoning cue and the few-shot layout words.
STEP_CUE = "Let's think step by step."
FEW_SHOT_TAIL = "Now you try:"

# Worked examples for demonstrations; callers pass their own.
EXEMPLARS = [
    {"question": "A shelf holds 4 rows of 6 jars. Two jars break. How many are left?",
     "steps": ["4 rows of 6 jars make 24 jars.", "24 less 2 is 22."], "answer": "22"},
    {"question": "A train leaves at 9:40 and arrives at 11:05. How many minutes does it travel?",
     "steps": ["From 9:40 to 10:40 are 60 minutes.", "From 10:40 to 11:05 are 25 minutes.", "60 and 25 make 85."],
     "answer": "85"},
]


def project_lang(translation: str | Column, lang: str) -> Column:
    """One language out of a ``map<lang, text>`` column."""
    c = F.col(translation) if isinstance(translation, str) else translation
    return F.element_at(c, F.lit(lang))


def instruction_prompt(instruction: str | Column, inp: str | Column) -> Column:
    """``Input: {input}\\nInstruction: {instruction}`` when input is non-empty."""
    i = F.col(instruction) if isinstance(instruction, str) else instruction
    x = F.col(inp) if isinstance(inp, str) else inp
    return F.when(F.coalesce(x, F.lit("")) != "",
                  F.concat(F.lit("Input: "), x, F.lit("\nInstruction: "), i)) \
        .otherwise(F.concat(F.lit("Instruction: "), i))


def zero_shot_prompt(question: str | Column) -> Column:
    """``Question: {q}\\nLet's think step by step.``"""
    q = F.col(question) if isinstance(question, str) else question
    return F.concat(F.lit("Question: "), q, F.lit("\n" + STEP_CUE))


def few_shot_prefix(exemplars=None) -> str:
    """The numbered exemplar block; exemplars are a short user-given list."""
    blocks = []
    for k, ex in enumerate(exemplars or EXEMPLARS, start=1):
        steps = "\n".join(f"{j}. {s}" for j, s in enumerate(ex["steps"], start=1))
        blocks.append(f"Example {k}\nQ: {ex['question']}\nA: {STEP_CUE}\n{steps}\n"
                      f"Answer: {ex['answer']}\n")
    return "\n" + "\n".join(blocks) + f"\n{FEW_SHOT_TAIL}\n"


def few_shot_prompt(question: str | Column, exemplars=None) -> Column:
    """Exemplars, then ``Now you try:`` and the open question."""
    q = F.col(question) if isinstance(question, str) else question
    return F.concat(F.lit(few_shot_prefix(exemplars) + "Q: "), q, F.lit(f"\nA: {STEP_CUE}\n"))


def label_name(pred: str | Column) -> Column:
    """Class id -> ``Positive`` / ``Negative``."""
    p = F.col(pred) if isinstance(pred, str) else pred
    return F.when(p == 1, F.lit("Positive")).otherwise(F.lit("Negative"))
