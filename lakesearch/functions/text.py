"""Column helpers for text, built from Spark's own functions."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, functions as F

# White space as Unicode has it, in lists and in patterns.
BLANKS = " \t\n\r\f\x0b\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
SPACES = r"(?U)\s+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    An expression used inside a higher-order function's lambda is evaluated again
    for every element; binding it to a lambda variable first avoids that.
    """
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def count_tokens(text: Column) -> Column:
    """Whitespace-separated words, the count used when no BPE tokenizer is plugged in."""
    return F.regexp_count(text, F.lit(r"(?U)\S+"))


def token_counter(load_tokenizer: Callable[[], Callable[[str], list]]) -> Callable[[Column], Column]:
    """A ``count_tokens`` for a plugged-in tokenizer, loaded once per task and fed by Arrow."""
    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load_tokenizer()
        for texts in batches:
            yield texts.map(lambda t: None if t is None else len(encode(t)))

    return count


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def suffix(path: Column) -> Column:
    """Lower-cased last extension with its dot; '' for ``.bashrc`` and for ``x.``."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def escape_regex(text: Column) -> Column:
    return F.regexp_replace(text, r"([^\p{L}\p{N}_])", r"\\$1")


def contains_any(text: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.contains(text, F.lit(word))
    return found


def sorted_set(items: Column) -> Column:
    return F.array_sort(F.array_distinct(items))


def lookup(mapping: dict[str, str], key: Column, default: str) -> Column:
    """Value of a small constant mapping."""
    entries = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), F.lit(default))
