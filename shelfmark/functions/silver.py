"""Silver-layer field rules of the museum and library sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.fixed import REFERENCE_SHELVES
from shelfmark.functions.text import blank_to_null, let, split_literal, split_values, strip
from shelfmark.functions.unicode import nfkc


def clean_extent(c: Column) -> Column:
    """``Dimensions, overall__5 inches__6 inches__height||...`` -> ``Inches 5 x 6 Height | ...``.

    Only measurements in inches are kept; number pieces are joined with `` x ``, the other pieces
    become labels.
    """

    def measurement(m: Column) -> Column:
        pieces = split_values(F.regexp_replace(m, r"dimensions,\s*overall", ""), "__")
        pieces = F.transform(pieces, lambda p: strip(F.regexp_replace(p, r"inches\s*", "")))
        pieces = F.filter(pieces, lambda p: p != "")
        numbers = F.filter(pieces, lambda p: p.rlike(r"^[\d\s./-]+$"))
        labels = F.filter(pieces, lambda p: ~p.rlike(r"^[\d\s./-]+$"))
        labels = F.transform(labels, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p))))
        text = F.concat_ws(
            " ",
            F.concat(F.lit("Inches "), F.array_join(numbers, " x ")),
            F.nullif(F.array_join(labels, ", "), F.lit("")),
        )
        return F.when(F.size(numbers) > 0, text)

    inches = F.filter(split_literal(F.lower(c), "||"), lambda m: m.contains("inches"))
    return F.coalesce(F.array_join(F.filter(F.transform(inches, measurement), F.isnotnull), " | "), F.lit(""))


def edtf_date(c: Column) -> Column:
    """``circa__1930__1935`` -> ``1930/1935~``; unknown or missing -> empty."""

    def joined(parts: Column) -> Column:
        circa = F.exists(parts, lambda p: F.lower(p) == "circa")
        dates = F.array_join(F.filter(parts, lambda p: F.lower(p) != "circa"), "/")
        return F.when(circa & (dates != ""), F.concat(dates, F.lit("~"))).otherwise(dates)

    text = let(split_values(c, "__"), joined)
    return F.when(c.isNull() | F.upper(c).contains("UNKNOWN"), F.lit("")).otherwise(text)


def edtf_display(c: Column) -> Column:
    """Reader's form of an EDTF date."""
    text = strip(c)
    uncertain, approximate = text.endswith("?"), text.endswith("~")
    body = F.when(uncertain | approximate, text.substr(F.lit(1), F.length(text) - 1)).otherwise(text)
    suffix = F.when(uncertain, " (year uncertain)").when(approximate, " (year approximate)").otherwise("")
    return F.coalesce(F.concat(F.replace(body, F.lit("/"), F.lit(" to ")), suffix), F.lit(""))


def agent_roles(c: Column, vocabulary: Sequence[tuple[str, str]], default: str = "oth") -> Column:
    """``Name__role||Name__role`` -> ``relators:code:person:Name|...``.

    ``vocabulary`` is an ordered list of (role text, code); the first role text contained in the
    agent's role decides. It is matched inside one expression, so no join and no shuffle.
    """
    table = F.array(*[F.struct(F.lit(k).alias("role"), F.lit(v).alias("code")) for k, v in vocabulary])

    def coded(agent: Column) -> Column:
        parts = F.split(agent, "__")
        name = strip(F.get(parts, F.lit(0)))
        role = F.replace(F.lower(F.coalesce(strip(F.get(parts, F.lit(1))), F.lit("other"))), F.lit("."), F.lit(""))
        code = F.get(F.filter(table, lambda t: role.contains(t["role"])), F.lit(0))["code"]
        return F.when(name != "", F.concat(F.lit("relators:"), F.coalesce(code, F.lit(default)), F.lit(":person:"), name))

    agents = F.filter(F.transform(split_literal(c, "||"), coded), F.isnotnull)
    return F.coalesce(F.array_join(agents, "|"), F.lit(""))


def credit_line(c: Column, default: str) -> Column:
    """Underscores out, NFKC, en dash to hyphen; null -> the institution's ``default`` text."""
    text = F.replace(nfkc(F.replace(c, F.lit("_"), F.lit(""))), F.lit("–"), F.lit("-"))
    return F.coalesce(text, F.lit(default))


def marc_date(preferred: Column, other: Column) -> Column:
    """Preferred date, else the other one, without imprint punctuation and copyright ``c``."""
    raw = F.coalesce(blank_to_null(preferred), blank_to_null(other))
    return blank_to_null(F.regexp_replace(F.regexp_replace(raw, r"[\[\]().,]", ""), r"\bc([0-9])", "$1"))


def shelf_location(c: Column) -> Column:
    """Shelf codes of the reading room -> ``Reference``."""
    shelf = strip(c)
    return F.when(shelf.isin(list(REFERENCE_SHELVES)), "Reference").otherwise(shelf)


def collection_type(location: Column) -> Column:
    return F.when(location == "Reference", "Research/Reference Books").otherwise("Library")


def catalog_link(identifier: Column, external_id: Column, template: str) -> Column:
    """Deep link into the library catalogue where the external id is all digits, else null.

    ``template`` holds ``{doc}`` and ``{id}``, each once and in this order.
    """
    before, _, rest = template.partition("{doc}")
    between, _, after = rest.partition("{id}")
    doc = strip(F.substring_index(external_id, ";", 1))
    first = strip(F.substring_index(identifier, ";", 1))
    link = F.concat(F.lit(before), doc, F.lit(between), F.coalesce(first, F.lit("")), F.lit(after))
    return F.when(doc.rlike("^[0-9]+$"), link)
