"""String canonicalisers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented Latin letters and the plain letter each stands for.
ACCENTED = "áàâäãåāéèêëēíìîïīóòôöõøōúùûüūýÿñçšžœæ"
PLAIN = "aaaaaaaeeeeeiiiiiooooooouuuuuyyncszoa"


def blank_to_null(c: Column) -> Column:
    """Trimmed text; null where nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def squeeze(c: Column) -> Column:
    """STR-08: runs of blanks of any kind become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"[\s ]+", " "))


def canonical(c: Column) -> Column:
    """Value without its typing: case, surrounding and repeated blanks; blank is null."""
    return F.nullif(F.lower(squeeze(c)), F.lit(""))


def canonical_id(c: Column) -> Column:
    """An id as it is referred to: trimmed, lower case, blank is no reference."""
    return F.nullif(F.lower(F.trim(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", ""))), F.lit(""))


def unaccent(c: Column) -> Column:
    """Lower case without accents, also where they are combining marks."""
    return F.regexp_replace(F.translate(F.lower(c), ACCENTED, PLAIN), r"\p{M}+", "")


def blankless(c: Column) -> Column:
    """STR-01: lower case letters and digits only; null is ''."""
    return F.coalesce(F.regexp_replace(F.lower(c), "[^a-z0-9]+", ""), F.lit(""))


#: Fixed values (STR-03): words that say nothing about which chain a legal name belongs to.
STEM_WORDS = "llc|l l c|inc|incorporated|corp|corporation|pc|p c|pllc|pa|lp|llp|ltd|co|company|group|holdings|holding|services|service|therapy|therapies|of|the"


def chain_stem(c: Column, length: int = 40) -> Column:
    """STR-03: legal name without punctuation and the words above, squeezed, cut to ``length``."""
    plain = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9 ]", " ")
    return F.substring(F.trim(F.regexp_replace(F.regexp_replace(plain, rf"\b(?:{STEM_WORDS})\b", " "), r"\s+", " ")), 1, length)


def without_registry_mark(c: Column) -> Column:
    """STR-06: display name without ``(CIK 0001234567)``; null where nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(c, r"\s*\(CIK\s*\d+\)", "")), F.lit(""))


def strip_tags(c: Column) -> Column:
    """STR-07."""
    return F.regexp_replace(c, r"<[^>]+>", " ")


#: Fixed values (STR-09): the named entities that texts contain.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&#039;": "'", "&rsquo;": "’", "&lsquo;": "‘", "&ndash;": "–", "&mdash;": "—", "&amp;": "&"}


def unescape(c: Column) -> Column:
    """STR-09: named entities as characters; ``&amp;`` last, so that nothing is unescaped twice."""
    for k, v in ENTITIES.items():
        c = F.replace(c, F.lit(k), F.lit(v))
    return c


def fragment_text(c: Column) -> Column:
    """STR-10: text of an HTML fragment, scripts, styles and comments left out."""
    return squeeze(unescape(strip_tags(F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "))))


def absolute_url(c: Column, base: Column) -> Column:
    """STR-11: absolute form of a link; a path takes scheme and host of ``base``, a bare domain https."""
    origin = F.concat(F.parse_url(base, F.lit("PROTOCOL")), F.lit("://"), F.parse_url(base, F.lit("HOST")))
    return F.when(c.rlike("(?i)^https?://"), c).when(c.startswith("//"), F.concat(F.lit("https:"), c)).when(c.startswith("/"), F.concat(origin, c)).when(F.trim(c) == "", None).otherwise(F.concat(F.lit("https://"), c))


def slug_title(c: Column, suffix: str = "") -> Column:
    """STR-12: ``oak-park-aba`` as ``Oak Park``, a trailing ``suffix`` dropped."""
    cut = F.regexp_replace(c, f"{suffix}$", "") if suffix else c
    return F.initcap(F.replace(cut, F.lit("-"), F.lit(" ")))


def without_suffix(c: Column, pattern: str) -> Column:
    """STR-13: what a case-blind ``pattern`` matches at the end is dropped."""
    return F.trim(F.regexp_replace(c, f"(?i)(?:{pattern})$", ""))


def percent(c: Column) -> Column:
    """STR-15."""
    return F.format_string("%.1f%%", c * 100)


def locality(*parts: Column) -> Column:
    """STR-19: non-empty parts, joined by a space."""
    return F.concat_ws(" ", *[F.nullif(F.trim(p), F.lit("")) for p in parts])


def detail(*parts: Column, most: int = 300) -> Column:
    """STR-17: parts that are there, joined by ``; `` and cut."""
    return F.substring(F.concat_ws("; ", *parts), 1, most)


def mentions(words: list[str], *columns: Column) -> Column:
    """FLT-15: one of ``words`` occurs in the columns' joined text, in any case, also inside a word."""
    return F.lower(F.concat_ws(" ", *columns)).rlike("|".join(words))


def display_name(name: Column, trade_name: Column) -> Column:
    """PRJ-02."""
    return F.coalesce(trade_name, name)


def title(name: Column, explicit: Column, fallback: Column) -> Column:
    """PRJ-03: an explicit name, else the name unless it is all capitals, else the fallback."""
    capitals = (name == F.upper(name)) & name.rlike("[A-Za-z]")
    return F.coalesce(explicit, F.when(~capitals, name), fallback, name)


def redacted(c: Column) -> Column:
    """STR-14: a connection string without its password; other text as it is."""
    return F.regexp_replace(c, r"(://[^:/@\s]*):[^@\s]*@", "$1:***@")


def assertion(kind: Column, **names: Column) -> Column:
    """STR-16: "A -> B" by kind of claim: site and owner, else owner and parent; unnamed ends are "?"."""
    end = lambda k: F.coalesce(F.nullif(F.trim(names[k]), F.lit("")), F.lit("?"))
    return F.when(kind == "clinic_to_owner", F.concat(end("site"), F.lit(" -> "), end("owner"))).when(kind == "owner_to_pe_firm", F.concat(end("owner"), F.lit(" -> "), end("parent")))


def source_class(urls: Column, classes: dict[str, str], otherwise: str = "other") -> Column:
    """STR-18: the first class whose part of an address occurs in one of ``urls``."""
    one = F.array_join(urls, " ")
    return F.coalesce(*[F.when(F.contains(one, F.lit(part)), F.lit(name)) for part, name in classes.items()], F.lit(otherwise))


def only_about(c: Column, subject: str, unless: list[str]) -> Column:
    """FLT-13: names ``subject`` and none of ``unless``, in any case; null is false."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return low.contains(subject) & ~low.rlike("|".join(unless))


def announced_only(c: Column, mark: str = "COMING SOON") -> Column:
    """FLT-14: carries the mark of a place that is not open, in any case; null does not."""
    return F.upper(F.coalesce(c, F.lit(""))).contains(mark)
