"""Whether a value that was read is proven by the document's text: quotes on pages, literal values, proven absences.

A document is a struct of pages (array of text, page 1 first), classes (array: text, ocr, sparse or image), truncated
(boolean) and unread (array of page numbers). What is unknown proves nothing: null, or classes that don't match the pages, count against.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlight.functions.identifiers import agency, verdict
from ledgerlight.functions.printed import printed_date, printed_dates
from ledgerlight.functions.text import common_length

#: Fields that text proves literally, and those that a quote on the cited page proves.
LITERAL = ("validity_from", "validity_to", "regulation", "ref_list", "basic_udi_di", "cert_number", "manufacturer")
QUOTED = ("type", "coverage_scope")
#: What labels a field. Where none stands in the text, an empty answer is proven, but for the manufacturer.
LABELS = {
    "validity_to": r"valid until|valid to|expir|gültig bis|gueltig bis|scadenza|valido fino|velja do|vrijedi do|valable jusqu",
    "validity_from": r"date|datum|issued|gültig ab|valid from|data|izdan",
    "cert_number": r"certific|zertifikat|certifikat|certificato|registration no",
    "basic_udi_di": r"\budi\b",
    "ref_list": r"\bref\b|article|artikel|art\.|item|catalog|katalog|šifra|codice|\bmodel",
    "regulation": r"2017/745|93/42|regulation|richtlinie|directive|uredb|direktiv",
}
#: Classes of pages that have text, of pages that prove no absence, and citations of the two regulations.
WITH_TEXT, UNRELIABLE, NEW_RULE, OLD_RULE = ("text", "ocr"), ("image", "ocr"), "2017/745", "93/42"
#: The least likeness of a quote, the share of references that must be printed, a notified body's number, an ellipsis.
QUOTE_MATCH, REFS_PRINTED, BODY_NUMBER, ELLIPSIS = 95, 0.95, r"(?i)^(?:CE|NB)?[\s-]?[0-9]{4}$", r"\.{3,}|…"


def nearly_in(piece: str, page: str, least: float = QUOTE_MATCH) -> bool:
    """Whether some window of the page, as long as the piece or cut off at an edge, is like it: 200 * common letters / total length.

    The letters that may be missing or added on the way are counted first. With d of them, one of d + 1 parts of the
    piece stands in the page as it is; only the windows that such a part can belong to are compared.
    """
    if len(piece) > len(page):
        piece, page = page, piece
    if not piece:
        return False
    if piece in page:
        return True
    m = len(piece)
    off = int(2 * m * (100 - least) / 100 + 1e-9)
    if not off:
        return False
    cuts = [m * i // (off + 1) for i in range(off + 2)]
    starts: set[int] = set()
    for a, b in zip(cuts, cuts[1:], strict=False):
        at = page.find(piece[a:b])
        while at >= 0:
            starts.update(range(at - a - off, at - a + off + 1))
            at = page.find(piece[a:b], at + 1)
    for s in sorted(starts):
        window = page[max(s, 0) : max(s + m, 0)]
        if window and 200 * common_length(piece, window) >= least * (m + len(window)) - 1e-9:
            return True
    return False


def quote_on_page(quote: str | None, page: int | None, pages: list[str] | None) -> bool:
    """Whether every piece of a quote, around ellipses, is on the cited page; without a page of that number, all on some one page."""
    plain = lambda s: " ".join((s or "").split()).casefold()
    pieces = [p for p in map(plain, re.split(ELLIPSIS, quote or "")) if p]
    pages = list(pages) if pages is not None else []
    if not pieces:
        return False
    looked = [pages[page - 1]] if page is not None and 1 <= page <= len(pages) else pages
    return any(all(nearly_in(p, text) for p in pieces) for text in map(plain, looked))


def on_page(quote: Column, page: Column, pages: Column) -> Column:
    """quote_on_page() of columns."""

    @F.pandas_udf("boolean")
    def found(quote: pd.Series, page: pd.Series, pages: pd.Series) -> pd.Series:
        return pd.Series([quote_on_page(q, None if pd.isna(n) else int(n), p) for q, n, p in zip(quote, page, pages, strict=True)], dtype="bool")

    return found(quote, page, pages)


def compact(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"(?U)\s+", ""))


def _whole_text(doc: Column) -> Column:
    return F.array_join(F.transform(F.coalesce(doc["pages"], F.array().cast("array<string>")), lambda p: F.coalesce(p, F.lit(""))), "\n")


def _some(doc: Column, classes: tuple[str, ...]) -> Column:
    return F.exists(doc["classes"], lambda c: c.isin(*classes))


def _uncut(doc: Column) -> Column:
    return ~F.coalesce(doc["truncated"], F.lit(True)) & (F.coalesce(F.size(doc["unread"]), F.lit(0)) <= 0)


def _classes_known(doc: Column) -> Column:
    return F.coalesce((F.size(doc["classes"]) > 0) & (F.size(doc["classes"]) == F.size(doc["pages"])), F.lit(False))


def covers_document(doc: Column) -> Column:
    """The text is the whole document: not cut, no page unread or an image, and some page has text."""
    return F.coalesce(_uncut(doc) & _classes_known(doc) & ~_some(doc, ("image",)) & _some(doc, WITH_TEXT), F.lit(False))


def _cited(value: Column, doc: Column) -> Column:
    """Whether the one citation in the text, or the lack of any, is the one that the value names."""
    text = compact(_whole_text(doc))
    new, old = F.contains(text, F.lit(NEW_RULE)), F.contains(text, F.lit(OLD_RULE))
    name = F.lower(F.trim(value))
    return covers_document(doc) & F.when(name == "mdr", new & ~old).when(name == "mdd", old & ~new).when(name == "n.a.", ~new & ~old).otherwise(False)


def _identifier_shaped(value: Column) -> Column:
    """Not one whose check characters are wrong, nor a word."""
    word = (agency(value) == "unknown") & ~value.rlike("[0-9]")
    return (verdict(value) != "INVALID") & ~word


def settled(field: Column, value: Column, codes: Column, quote: Column, page: Column, doc: Column) -> Column:
    """Whether a value that is not empty is proven by the document's text.

    value: text; codes: array of text, for ref_list. Type and scope need their quote on the cited page; a regulation its
    citation and not the other one; a list 95 % of its codes; the others a quote on the page and the value in the text: a date must be in the quote,
    an identifier mustn't fail its check, and a certificate's number mustn't be a notified body's.
    """
    text = compact(_whole_text(doc))
    listed = F.transform(F.filter(codes, lambda c: F.trim(c) != ""), compact)
    enough = F.size(F.filter(listed, lambda c: F.contains(text, c))) >= F.lit(REFS_PRINTED) * F.size(listed)
    quoted = on_page(quote, page, doc["pages"])
    iso = F.transform(F.regexp_extract_all(quote, F.lit("[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.lit(0)), lambda x: x)
    dated = F.array_contains(F.transform(printed_dates(quote), lambda x: x["date"].cast("string")), value) | F.array_contains(iso, value)
    literal = quoted & F.contains(text, compact(value))
    answer = (
        F.when(field == "ref_list", (F.size(listed) > 0) & enough)
        .when(F.coalesce(F.trim(value), F.lit("")) == "", False)
        .when(field.isin(*QUOTED), quoted)
        .when(field == "regulation", _cited(value, doc))
        .when(field.isin("validity_from", "validity_to"), quoted & dated)
        .when(field == "basic_udi_di", literal & _identifier_shaped(value))
        .when(field == "cert_number", literal & ~F.trim(value).rlike(BODY_NUMBER))
        .when(field == "manufacturer", literal)
    )
    return F.coalesce(answer, F.lit(False))


def null_settled(field: Column, doc: Column) -> Column:
    """Whether one empty answer is proven: no label of the field in a text that was read whole and can be relied on."""
    label = F.element_at(F.create_map(*[F.lit(x) for k, v in LABELS.items() for x in (k, f"(?iu){v}")]), field)
    trusted = _uncut(doc) & _classes_known(doc) & _some(doc, WITH_TEXT) & ~_some(doc, UNRELIABLE)
    return F.coalesce(trusted & ~F.rlike(_whole_text(doc), label), F.lit(False))


def both_null_settled(field: Column, doc: Column) -> Column:
    """Whether two empty answers are proven: always where all was read, but for an identifier whose label is printed or can't be seen."""
    seen = ~F.coalesce(_some(doc, WITH_TEXT), F.lit(False)) | _whole_text(doc).rlike(f"(?iu){LABELS['basic_udi_di']}")
    return F.coalesce(_uncut(doc) & ~((field == "basic_udi_di") & seen), F.lit(False))


def citation_proven(value: Column, doc: Column) -> Column:
    """Whether a regulation, written as it is stored, is proven by the one citation in a text that is the whole document."""
    return F.coalesce(value.isin("MDR", "MDD", "n.a.") & _cited(value, doc), F.lit(False))


def issue_date_proven(value: Column, quote: Column, page: Column | None = None, doc: Column | None = None) -> Column:
    """Whether a date of issue is printed by its own quote and, where the cited page was read as text, on that page."""
    printed = printed_date(value, quote)
    proven = value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull() & printed.isNotNull()
    if doc is not None:
        readable = page.between(1, F.size(doc["pages"])) & ~F.coalesce(F.array_contains(doc["unread"], page), F.lit(False))
        readable = readable & (~_classes_known(doc) | F.get(doc["classes"], page - 1).isin(*WITH_TEXT))
        proven = proven & (~F.coalesce(readable, F.lit(False)) | F.contains(compact(F.get(doc["pages"], page - 1)), compact(printed)))
    return F.coalesce(proven, F.lit(False))
