"""JSON objects and tool calls inside free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text shapes an answer may come in.
FENCED = r"```(?:json)?\s*(\{[\s\S]*?\})\s*```"
FINAL_ANSWER = r"Final Answer:\s*(\{[\s\S]*\})"
TOOL_CALL = r"""Action:\s*(\w+)\s*\(\s*["']([\s\S]*?)["']\s*\)"""


def _if_json(text: Column) -> Column:
    return F.when(F.try_parse_json(text).isNotNull(), text)


def extract_json(text: Column) -> Column:
    """The JSON in a text: the first fenced block, else the outermost braces, else all of it."""
    fenced = F.regexp_extract(text, FENCED, 1)
    start = F.locate("{", text)
    end = F.length(text) - F.locate("}", F.reverse(text)) + 1
    braces = F.when(
        (start > 0) & (F.locate("}", text) > 0) & (end >= start), F.substring(text, start, end - start + 1)
    )
    return F.coalesce(_if_json(F.when(fenced != "", fenced)), _if_json(braces), _if_json(text))


def final_answer(text: Column) -> Column:
    """JSON after ``Final Answer:``; the whole text is tried when that part is not JSON."""
    marked = F.regexp_extract(text, FINAL_ANSWER, 1)
    return F.when(marked != "", F.coalesce(extract_json(marked), extract_json(text)))


def tool_name(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, TOOL_CALL, 1), F.lit(""))


def tool_argument(text: Column) -> Column:
    return F.when(tool_name(text).isNotNull(), F.regexp_extract(text, TOOL_CALL, 2))
