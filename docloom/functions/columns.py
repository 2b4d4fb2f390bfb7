"""Column builders shared by operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.errors import RuleError


def require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise RuleError(f"unknown columns: {', '.join(missing)}")


def is_array(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() == "array"


def java_regex(pattern: str) -> str:
    """A Python pattern in Java's dialect; syntax that only Python has is refused."""
    try:
        re.compile(pattern)
    except re.error as problem:
        raise RuleError(f"not a pattern: {pattern}") from problem
    out = pattern.replace("(?P<", "(?<")
    if "(?P=" in out or "(?P>" in out:
        raise RuleError(f"named references are not supported: {pattern}")
    return re.sub(r"\\Z", r"\\z", out)


def java_replacement(text: str) -> str:
    r"""A Python replacement template (\1, \g<1>) as Java writes it ($1)."""
    out, i = "", 0
    while i < len(text):
        if m := re.compile(r"\\(?:g<(\w+)>|(\d))").match(text, i):
            out += "${" + m[1] + "}" if m[1] and not m[1].isdigit() else "$" + (m[1] or m[2])
            i = m.end()
            continue
        out += "\\" + text[i] if text[i] in "$\\" else text[i]
        i += 1
    return out


def is_pattern(text: str) -> bool:
    try:
        re.compile(text)
    except re.error:
        return False
    return True


def matches(column: Column, pattern: str) -> Column:
    """Case-blind search; null never matches."""
    return F.coalesce(column.rlike("(?i)" + java_regex(pattern)), F.lit(False))


def question_id(question: Column, answer: Column) -> Column:
    return F.md5(F.concat(F.lit("question: "), question, F.lit("|answer: "), answer))


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def iso_time(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def run_id(text: str) -> Column:
    return F.left(F.sha1(F.lit(text)), F.lit(7))


def is_zero_vector(column: Column) -> Column:
    return F.forall(column, lambda x: x == 0)


#: Openings by which chat models refuse a request.
REFUSALS = (
    r"^.*?\bi(?:(?: am|\\?'?m)\b (?:(?:not |un)able) to|(?:\b can(?:\\?'?t|not))) (?:(?:complete|fulfill|provide|(?:help|assist)(?: with)?|perform|translate) )(?:(?:a|the|this|that|your) )?(?:request|provided|translat(?:ion|ed)|task).*?$",
    r"^.*?sorry,? (?:but )?it (?:seems|looks|appears).*?(?:(?:provided \w+|\w+ (?:is|provided))|there (?:was|might|may).*?(?:typo|mistake|error)|(?:sent|entered|provided) the wrong \w+|you have).*?$",
    r"^.*?(?:\w+ (?:requested|provided)|(?:requested|provided) \w+|request|text|content|this) is (?:not (?:possible|clear|available)|too (?:long|complex|lengthy)|incomplete).*?$",
    r"^.*?sorry,? (?:but )?i need.*? to (?:provide|complete|fulfill|help (?:with)?|perform).*?$",
    r".*?sorry,? (?:but )?(?:it is not possible to ).*?without.*?$",
    r"^.*?sorry,? (?:but )?it (?:seems|looks|appears) (?:that|like)? ? (?:you haven\\?'?t provided|I haven\\?'?t received).*?$",
    r"^.*?\w+ is not provided.*?provide the \w+ to be \w+.*?$",
    r"^.*?the \w+ (?:could not|can(?:\\?'?t|not)) be translated.*?$",
    r"^.*?the \w+.*?is not in \w+.*?it can(?:\\?'?t|not) be \w+.*?$",
)


def is_refusal(column: Column) -> Column:
    """Whether an answer's first line is a refusal."""
    found = F.lit(False)
    for pattern in REFUSALS:
        found = found | column.rlike(r"(?im)\A" + pattern.removeprefix("^"))
    return F.coalesce(found, F.lit(False))


_REPLY = "struct<choices:array<struct<finish_reason:string,message:struct<content:string,refusal:string,tool_calls:array<struct<function:struct<arguments:string>>>>>>>"


def checked_reply(reply: Column, tool: bool = False) -> Column:
    """(text, problem) of a chat completion as JSON; the text is null where there is a problem.

    ``text`` is the content, or the arguments of the first tool call if there is one (with ``tool`` there must be one, and
    its arguments must be JSON). Problems: no response, content filter, length, refusal, no tool call, broken arguments.
    """
    first = F.get(F.from_json(reply, _REPLY)["choices"], 0)
    message = first["message"]
    arguments = F.get(message["tool_calls"], 0)["function"]["arguments"]
    text = F.coalesce(arguments, F.lit(None).cast("string") if tool else message["content"])
    problem = (
        F.when(first.isNull(), "no response").when(first["finish_reason"] == "content_filter", "content filter").when(first["finish_reason"] == "length", "length")
        .when(F.coalesce(message["refusal"], F.lit("")) != "", "refusal").when(F.lit(tool) & arguments.isNull(), "no tool call")
        .when(arguments.isNotNull() & F.try_parse_json(arguments).isNull(), "broken arguments").when(text.isNull(), "no response")
    )
    return F.struct(F.when(problem.isNull(), text).alias("text"), problem.alias("problem"))
