"""Small pieces of SQL text for words of a text, shared by the native operators."""

from __future__ import annotations

#: Space and the five ASCII control characters that separate words.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"r'[\x20\x09-\x0D]+'"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is evaluated once per row.

    A column alias gives no such promise: the optimizer may copy its expression
    into a lambda, which then evaluates it for every element.
    """
    return f"transform(array({value}), {name} -> {body})[0]"


def words(text: str) -> str:
    """Array of the words of a text; empty for NULL and blank texts."""
    trimmed = f"btrim(coalesce({text}, ''), '{BLANKS}')"
    return f"if({trimmed} = '', cast(array() AS array<string>), split({trimmed}, {BLANK_RUN}))"


def plain_words(text: str) -> str:
    """Array of the runs of digits, letters and non-ASCII characters, in lower case."""
    return rf"regexp_extract_all(lower(coalesce({text}, '')), r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+', 0)"


def run_hash(words_name: str, at: str, size: int) -> str:
    """Hash of ``size`` consecutive words from position ``at``."""
    return f"xxhash64({size}, " + ", ".join(f"get({words_name}, cast({at} + {k} AS int))" for k in range(size)) + ")"
