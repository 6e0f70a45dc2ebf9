"""Text expressions: literals, JSON strings, whitespace, token counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogsearch.functions.binding import bind

# Characters a Python string literal shows as an escape: controls and separators, the space aside.
_ESCAPED = r"[\p{C}\p{Z}&&[^ ]]"
# JSON tokens: strings, punctuation, and the rest (numbers, true, false, null).
_JSON_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{},:]|[^\s\[\]{},:"]+'
# Estimated tokens: a run of word characters, or any other character that is no white space.
WORD = "[A-Za-z0-9_]+"
SPACES = " \t\n\r"
#: Spark's JSON reader else refuses strings of more than 20 million characters.
READ_ALL = {"maxStringLen": "2147483647"}


def _escape_code(char: Column) -> Column:
    code = F.ascii(char)
    return (
        F.when(code < 0x100, F.format_string("\\x%02x", code))
        .when(code < 0x10000, F.format_string("\\u%04x", code))
        .otherwise(F.format_string("\\U%08x", code))
    )


def _escaped(text: Column) -> Column:
    body = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for char, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(char), F.lit(shown))

    def by_character(shown: Column) -> Column:
        chars = F.transform(F.split(shown, ""), lambda c: F.when(c.rlike(_ESCAPED), _escape_code(c)).otherwise(c))
        return F.when(shown.rlike(_ESCAPED), F.array_join(chars, "")).otherwise(shown)

    return bind(body, by_character)


def py_quote(text: Column) -> Column:
    """Text as a Python string literal."""

    def quoted(t: Column) -> Column:
        return F.when(
            F.contains(t, F.lit("'")) & ~F.contains(t, F.lit('"')), F.concat(F.lit('"'), _escaped(t), F.lit('"'))
        ).otherwise(F.concat(F.lit("'"), F.replace(_escaped(t), F.lit("'"), F.lit("\\'")), F.lit("'")))

    return bind(text, quoted)


def py_literal(json: Column) -> Column:
    """JSON text as the Python literal of the same value."""

    def shown(token: Column) -> Column:
        string = F.from_json(F.concat(F.lit('{"v":'), token, F.lit("}")), "v string", READ_ALL)["v"]
        return (
            F.when(token.startswith('"'), py_quote(string))
            .when(token.isin(",", ":"), F.concat(token, F.lit(" ")))
            .when(token == "true", "True")
            .when(token == "false", "False")
            .when(token == "null", "None")
            .otherwise(token)
        )

    return F.array_join(F.transform(F.regexp_extract_all(json, F.lit(_JSON_TOKEN), F.lit(0)), shown), "")


def json_string(text: Column) -> Column:
    """Text as a JSON string, quotes included; null stays null."""
    # The brackets of a list of one go; those of the text are inside its quotes.
    return bind(text, lambda t: F.when(t.isNotNull(), F.btrim(F.to_json(F.array(t)), F.lit("[]"))))


def embeddable_text(content: Column) -> Column:
    """Document text as sent to the embedder: one line, never null."""
    return F.translate(F.coalesce(content, F.lit("")), "\n", " ")


def collapse_newlines(text: Column) -> Column:
    """At most three newlines in a row."""
    return F.regexp_replace(text, "\n{3,}", "\n\n\n")


def estimate_tokens(text: Column) -> Column:
    """Number of words and single symbols, as an estimate of model tokens."""
    one_each = F.translate(F.regexp_replace(text, WORD, "w"), SPACES, "")
    return F.length(one_each).cast("bigint")
