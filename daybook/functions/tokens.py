"""Vocabularies and token lists as column expressions.

A reference list comes as a map column (folded token -> struct(role, values)),
made by :func:`daybook.sources.maps.lookup_column`; it is a literal, so lookups
need no join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.dates import let

#: Agencies whose numbers may stand in a case number, in the order they are listed.
AGENCIES = ("NUPD", "HTPD", "MCSO", "CSA", "GEN")
MARKER = "audit_marker"


def fold_token(token: Column) -> Column:
    """The spelling by which tokens are looked up: blanks collapsed, lower case, no dots at the end."""
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(F.coalesce(token, F.lit("")), r"(?U)\s+", " "))), r"\.+$", "")


def tokenize(raw: Column) -> Column:
    """The tokens of a ``;`` list without empty ones; commas never split."""
    return F.filter(F.split(F.trim(F.coalesce(raw, F.lit(""))), r"\s*;\s*"), lambda t: t != "")


def split_flags(value: Column) -> Column:
    """The parts of a ``|`` list without empty ones."""
    return F.filter(F.split(F.coalesce(value, F.lit("")), r"\|"), lambda f: f != "")


def before_and_after_marker(tokens: Column, is_marker) -> tuple[Column, Column]:
    """(superseded, current): tokens before the last marker, and the marker with those after it."""
    at = F.coalesce(F.array_max(F.transform(tokens, lambda t, i: F.when(is_marker(t), i + 1).otherwise(0))), F.lit(0))
    superseded = F.slice(tokens, F.lit(1), F.greatest(at - 1, F.lit(0)))
    current = F.when(at == 0, tokens).otherwise(F.slice(tokens, F.greatest(at, F.lit(1)), F.size(tokens)))
    return superseded, current


def _looked_up(tokens: Column, lookup: Column, fold) -> Column:
    """Tokens with their entries: array of struct(token, entry)."""
    return F.transform(tokens, lambda t: F.struct(t.alias("token"), F.try_element_at(lookup, fold(t)).alias("entry")))


def _sides(looked_up: Column, body) -> Column:
    """``body`` of (superseded, current, unknown) token structs."""

    def of(split: Column) -> Column:
        return body(split["superseded"], split["current"], split["unknown"])

    def split(known: Column, unknown: Column) -> Column:
        superseded, current = before_and_after_marker(known, lambda x: x["entry"]["role"] == MARKER)
        return F.struct(superseded.alias("superseded"), current.alias("current"), unknown.alias("unknown"))

    def parts(x: Column) -> Column:
        known, unknown = F.filter(x, lambda t: t["entry"].isNotNull()), F.filter(x, lambda t: t["entry"].isNull())
        return let(F.struct(known.alias("known"), unknown.alias("unknown")), lambda k: let(split(k["known"], k["unknown"]), of))

    return let(looked_up, parts)


def categorize(nature: Column, lookup: Column) -> Column:
    """Categories of a nature: struct(categories, reclassified_from, was_reclassified, objects, activity, channels, unclassified).

    Offences and markers give categories; the other roles are listed as
    written.  Tokens the list lacks are in ``unclassified``.
    """

    def body(superseded: Column, current: Column, unknown: Column) -> Column:
        def values(of: Column) -> Column:
            giving = F.filter(of, lambda t: t["entry"]["role"].isin("offense", MARKER))
            return F.array_distinct(F.flatten(F.transform(giving, lambda t: t["entry"]["values"])))

        def listed(role: str) -> Column:
            return F.transform(F.filter(current, lambda t: t["entry"]["role"] == role), lambda t: t["token"])

        found = F.struct(values(current).alias("now"), values(superseded).alias("before"))
        return let(
            found,
            lambda v: F.struct(
                v["now"].alias("categories"),
                F.array_except(v["before"], v["now"]).alias("reclassified_from"),
                (F.size(superseded) > 0).alias("was_reclassified"),
                listed("object").alias("objects"),
                listed("activity").alias("activity"),
                listed("channel").alias("channels"),
                F.transform(unknown, lambda t: t["token"]).alias("unclassified"),
            ),
        )

    return _sides(_looked_up(tokenize(nature), lookup, fold_token), body)


def disposition_flags(disposition: Column, lookup: Column) -> Column:
    """Flags of a disposition: struct(flags, disposition_amended, superseded_flags, unclassified).

    Tokens are folded once; ``superseded_flags`` keeps repeats; unknown tokens
    are listed folded.
    """
    folded = F.filter(F.transform(tokenize(disposition), fold_token), lambda t: t != "")

    def body(superseded: Column, current: Column, unknown: Column) -> Column:
        values = lambda of: F.flatten(F.transform(of, lambda t: t["entry"]["values"]))
        found = F.struct(F.array_distinct(values(current)).alias("now"), values(superseded).alias("before"))
        return let(
            found,
            lambda v: F.struct(
                v["now"].alias("flags"),
                (F.size(superseded) > 0).alias("disposition_amended"),
                F.filter(v["before"], lambda f: ~F.array_contains(v["now"], f)).alias("superseded_flags"),
                F.transform(unknown, lambda t: t["token"]).alias("unclassified"),
            ),
        )

    return _sides(_looked_up(folded, lookup, lambda t: t), body)


def agencies(case_number: Column, names: tuple[str, ...] = AGENCIES) -> Column:
    """Agencies named in a case number, in the order of ``names``."""
    found = F.array(*[F.when(F.coalesce(case_number, F.lit("")).rlike(rf"(?i)\b{n}\b"), n) for n in names])
    return F.filter(found, lambda n: n.isNotNull())


def campus_name(raw: Column, lookup: Column) -> Column:
    """The campus a spelling stands for, else the spelling, else "Unknown"."""
    text = F.trim(F.coalesce(raw, F.lit("")))
    return F.coalesce(F.try_element_at(lookup, fold_token(text)), F.nullif(text, F.lit("")), F.lit("Unknown"))


def escape_html(text: Column) -> Column:
    """Text for use in HTML."""
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(mark), F.lit(entity))
    return text


def clip(text: Column, most: int) -> Column:
    """Text of at most ``most`` characters, with an ellipsis where it was longer."""
    return F.when(F.length(text) > most, F.concat(F.rtrim(F.substring(text, 1, most - 1)), F.lit("…"))).otherwise(text)


def text_search(term: str, *fields: Column) -> Column:
    """Whether ``term`` stands in any of the fields, letter case apart."""
    return F.contains(F.lower(F.concat_ws(" ", *[F.coalesce(f, F.lit("")) for f in fields])), F.lit(term.strip().lower()))
