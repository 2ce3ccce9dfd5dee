"""SELECT statements kept in files, one per target table."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.times import run_variables

VARIABLE = re.compile(r"\$\{([^}]*)\}")

#: What a statement consists of. The first form that fits decides, so an apostrophe in a comment
#: opens no text, and two hyphens in a text open no comment. A form that is opened and not
#: closed reaches to the end.
_FORMS = re.compile(
    r"""
    (?P<line_comment> -- (?: \\\n | [^\n\r] )* )
  | (?P<block_comment> /\* )
  | (?P<raw> \b[rR] (?: '[^']*(?:'|\Z) | "[^"]*(?:"|\Z) ) )
  | (?P<text> ' (?: [^'\\] | \\. | '' )* (?:'|\Z) | " (?: [^"\\] | \\. | "" )* (?:"|\Z) )
  | (?P<name> ` (?: [^`] | `` )* (?:`|\Z) )
  | (?P<variable> \$\{[^}]*\} )
    """,
    re.VERBOSE | re.DOTALL,
)
_COMMENT_EDGE = re.compile(r"/\*|\*/")


def run_stored_query(
    spark: SparkSession, directory: str, target_table: str, as_of: dt.date | str
) -> DataFrame:
    """Run the query stored for a table, with the run's dates as named parameters.

    The text may name them ``:as_of_date`` or, as older files do, ``${as_of_date}``. The
    values bring their own quotes: a variable inside quotes of any kind, which would be read as text
    or as a name, and an unknown one are refused, and so is a folder of several files.
    Comments are left out, whatever they hold; hints stay.
    """
    path = f"{directory}/{target_table.lower()}.hql"
    files = spark.read.text(path, wholetext=True).take(2)
    if len(files) != 1:
        raise ValueError(f"{path} must be one file, or a folder that holds one")
    variables = run_variables(as_of)
    try:
        text = with_parameters(files[0][0], variables)
    except ValueError as error:
        raise ValueError(f"{path} {error}") from None
    return spark.sql(text, args=variables)


def with_parameters(statement: str, known: dict[str, str]) -> str:
    """The statement without comments and final semicolons, its variables as named parameters."""
    out, unknown, quoted = [], set(), []
    for kind, part in tokens(statement):
        if kind == "comment":
            out.append(" ")
        elif kind == "variable":
            name = VARIABLE.fullmatch(part)[1]
            if name not in known:
                unknown.add(name)
            out.append(f":{name}")
        else:
            inside = VARIABLE.findall(part)
            if kind == "quoted" and inside:
                quoted.append(part)
            out.append(part)
    if quoted:
        raise ValueError(f"has variables inside quotes: {', '.join(quoted)}")
    if unknown:
        raise ValueError(f"names unknown variables: {', '.join(sorted(unknown))}")
    return "".join(out).strip().rstrip("; \t\r\n")


def tokens(statement: str) -> Iterator[tuple[str, str]]:
    """Parts of a statement in order: ``comment``, ``quoted``, ``variable`` or ``other``."""
    at = 0
    while found := _FORMS.search(statement, at):
        if found.start() > at:
            yield "other", statement[at : found.start()]
        at = found.end()
        kind = found.lastgroup
        if kind == "block_comment":
            at = _comment_end(statement, at)
            if statement.startswith("/*+", found.start()):
                kind = "hint"
        yield {"line_comment": "comment", "block_comment": "comment", "variable": "variable"}.get(
            kind, "quoted"), statement[found.start() : at]
    if at < len(statement):
        yield "other", statement[at:]


def _comment_end(statement: str, at: int) -> int:
    """Behind the comment opened before ``at``; comments nest."""
    depth = 1
    while depth:
        edge = _COMMENT_EDGE.search(statement, at)
        if edge is None:
            raise ValueError("has a comment that is not closed")
        depth += 1 if edge[0] == "/*" else -1
        at = edge.end()
    return at
