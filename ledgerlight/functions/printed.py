"""What a document prints, as Spark expressions over whole texts: labelled dates, lists of references, month and year of a revision."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlight.functions.dates import MONTHS, parse_printed_date

#: Labels of a date of expiry and of a date of issue, in order of precedence.
UNTIL_LABELS = ("expiry date", "valid until", "declaration valid until", "gültig bis", "gültigkeitsdatum", "veljavnost do", "valid to")
FROM_LABELS = ("current issue date", "first issue date", "issue date", "date of issue", "effective date", "valid from", "valid as of", "izdano")
#: Fixed value: the label that a line about a version of a form carries too.
STAMPED = ("valid as of", "version")
#: How far behind its label a date is looked for, and how sure a labelled and a signature date are.
WINDOW, LABELLED, SIGNED = 60, 1.0, 0.95
#: Letters with accents and the letters that fonts print in their place; one for one, so that places stay.
ACCENTED, PLAIN = "äöüàáâåèéêëìíîòóôøùúûçñščćžđ", "aouaaaaeeeeiiioooouuucnscczd"

_NAMES = "|".join(sorted(MONTHS, key=lambda m: (-len(m), m)))
_NUMERIC = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}"
_NAMED = rf"\b(?:{_NAMES})\.?\s+[0-9]{{1,2}}(?:st|nd|rd|th)?,?\s+[0-9]{{4}}|\b[0-9]{{1,2}}(?:\.?\s*|-)(?:{_NAMES})\.?(?:\s+|-)[0-9]{{4}}"
#: The shapes of a printed date, and of a line of a place, a comma and a date.
DATE = rf"(?iu)(?:[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}|[0-9]{{1,2}}[./][ \t]*[0-9]{{1,2}}[./][ \t]*[0-9]{{4}}|{_NAMED})"
PLACE_AND_DATE = rf"(?imu)^[ \t]*[A-Za-zÀ-ž][A-Za-zÀ-ž .'\-]{{1,40}},[ \t]*[.…_]*[ \t]*({_NUMERIC}|{_NAMED})[ \t]*[.…_]*[ \t]*$"

EVIDENCE = "struct<value:date,conf:double,verbatim:string>"
DATES = f"struct<validity_to:{EVIDENCE},validity_from:{EVIDENCE},refused:array<string>>"


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _folded(text: Column) -> Column:
    """Lower case without accents, every letter in its place."""
    # a text of bytes for letters has none to fold, and letters are looked up one by one
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(F.lower(F.translate(text, "İ", "I")), ACCENTED, PLAIN))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is made once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _place(low: Column, label: Column) -> Column:
    """Where a label first stands, from 1; 0 if nowhere. A stamped label doesn't count on a line about a version."""
    begin = F.struct(F.lit(0).alias("before"), F.lit(0).alias("at"))

    def look(acc: Column, line: Column) -> Column:
        here = F.when((acc["at"] == 0) & ~F.contains(line, F.lit(STAMPED[1])), F.locate(STAMPED[0], line)).otherwise(0)
        return F.struct((acc["before"] + F.length(line) + 1).alias("before"), F.when(here > 0, acc["before"] + here).otherwise(acc["at"]).alias("at"))

    unstamped = F.aggregate(F.split(low, "\n", -1), begin, look, lambda acc: acc["at"])
    return F.when(label == STAMPED[0], F.when(F.contains(low, label), unstamped).otherwise(0)).when(F.contains(low, label), F.instr(low, label)).otherwise(0)  # contains is the faster one


def _labelled(text: Column, low: Column, labels: Column, adjacent: bool) -> tuple[Column, Column]:
    """The evidence of the first label with a safe and real date behind it; whether some label's date was refused."""
    # each step binds what the next one uses more than once
    found = F.filter(F.transform(labels, lambda x: F.struct(x.alias("label"), _place(low, x).alias("at"))), lambda x: x["at"] > 0)
    windows = F.transform(found, lambda x: F.struct(x["label"], x["at"], F.substring(text, x["at"] + F.length(x["label"]), F.lit(WINDOW)).alias("window")))
    hits = F.transform(windows, lambda x: F.struct(x["label"], x["at"], x["window"], F.regexp_instr(x["window"], F.lit(DATE)).alias("behind"), F.regexp_extract(x["window"], DATE, 0).alias("date")))
    told = F.transform(
        F.filter(hits, lambda x: x["behind"] > 0),
        lambda x: F.struct(x["label"], x["at"], x["behind"], x["date"], F.substring(x["window"], F.lit(1), x["behind"] - 1).alias("between")),
    )
    bare = lambda x: x["between"].rlike(r"^[\s:., –—-]*$")
    safe = bare if adjacent else lambda x: bare(x) | ~F.contains(x["between"], F.lit(":"))
    refused = F.exists(told, lambda x: ~safe(x))
    read = F.transform(F.filter(told, safe), lambda x: F.struct(parse_printed_date(x["date"]).alias("value"), x["label"], x["at"], x["behind"], x["date"]))
    best = F.get(F.filter(read, lambda x: x["value"].isNotNull()), F.lit(0))
    span = F.substring(text, best["at"], F.length(best["label"]) + best["behind"] - 1 + F.length(best["date"]))
    evidence = F.struct(best["value"].alias("value"), F.lit(LABELLED).alias("conf"), F.trim(F.regexp_replace(span, r"[\s ]+", " ")).alias("verbatim"))
    return F.when(best["value"].isNotNull(), evidence), refused


def labelled_dates(text: Column, until_labels: Column | None = None, from_labels: Column | None = None) -> Column:
    """(validity_to, validity_from, refused): the dates that stand behind their labels, each with its confidence and quote.

    A label looks at the first date within 60 characters. A date of expiry must follow its label directly; a date of
    issue may have other words before it, but no colon, which would make it another label's. A label that may not take its date leaves it to
    the next label; fields that were refused and got no other date are listed. Without a labelled date of issue, a line that is a place, a
    comma and a date gives it. The labels that a manufacturer adds, arrays of text, come after the general ones.
    """
    more = lambda general, own: _array(map(str, general)) if own is None else F.concat(_array(general), F.coalesce(own, _array([])))
    both = [F.transform(more(general, own), _folded) for general, own in ((UNTIL_LABELS, until_labels), (FROM_LABELS, from_labels))]

    def found(s: Column) -> Column:
        until, until_refused = _labelled(s["text"], s["low"], s["until"], True)
        since, since_refused = _labelled(s["text"], s["low"], s["since"], False)
        return F.struct(until.alias("until"), since.alias("since"), until_refused.alias("until_refused"), since_refused.alias("since_refused"))

    def signed(text: Column) -> Column:
        line = lambda x: F.when(x["value"].isNotNull(), x)
        made = lambda x: F.struct(parse_printed_date(F.regexp_extract(x, PLACE_AND_DATE, 1)).alias("value"), F.lit(SIGNED).alias("conf"), F.trim(x).alias("verbatim"))
        return F.when(text.rlike("[0-9]{4}"), let(F.regexp_extract(text, PLACE_AND_DATE, 0), lambda x: let(made(x), line)))

    def joined(x: Column) -> Column:
        since = F.coalesce(x["since"], signed(text))
        lost = lambda refused, got, name: F.when(F.coalesce(refused, F.lit(False)) & got, F.lit(name))
        return let(
            F.struct(x["until"].alias("until"), since.alias("since"), x["until_refused"], x["since_refused"]),
            lambda y: F.struct(
                y["until"].alias("validity_to"), y["since"].alias("validity_from"),
                F.array_compact(F.array(lost(y["until_refused"], y["until"].isNull(), "validity_to"), lost(y["since_refused"], y["since"].isNull(), "validity_from"))).alias("refused"),
            ),
        )

    # lambdas bind what is used more than once, so that it is made once for a text
    bound = F.struct(text.alias("text"), _folded(text).alias("low"), both[0].alias("until"), both[1].alias("since"))
    return let(let(bound, found), joined).cast(DATES)


# ---- lists of references

#: A header of a column of references, what a reference isn't, and a line that is one.
REF_HEADER = r"(?i)ref|article|artikel|art\.?\s*no|cat\.?\s*no|bestell|id\b"
LONGEST_REF, OTHER_PREFIX, PROSE = 30, "++", r"[a-z]{2,}"
REF_LINE = r"^[A-Za-z0-9][A-Za-z0-9.\-/]{1,19}$"
DATE_LINE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$|^[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}$"
FOOTERS = ("signature", "unterschrift", "podpis", "datum", "ort", "place", "seite", "page ")
CODE_LABEL, CODE = r"(?i)^\s*(?:codici\s*/\s*)?codes?\s*:\s*$", r"^[0-9]{4,}$"

_CODES = "array<string>"
_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
_STRIP = r"^[\s ]+|[\s ]+$"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, _STRIP, "")


def _cells(line: Column) -> Column:
    """The cells of a line of a table: between tabs, bars or at least two spaces."""
    return F.when(line.rlike(r"\||\t| {2}"), F.transform(F.split(_strip(line), r"\s*\|\s*|\t+| {2,}"), _strip)).otherwise(F.array(line))


def ref_column(header: Column) -> Column:
    """The place, from 0, of the first cell that heads references, rather one that doesn't speak of identifiers; -1 if none does."""
    marks = F.transform(header, lambda c: F.when(F.coalesce(c, F.lit("")).rlike(REF_HEADER), F.when(F.contains(F.lower(c), F.lit("udi")), 1).otherwise(2)).otherwise(0))
    return (F.coalesce(F.nullif(F.array_position(marks, 2), F.lit(0)), F.array_position(marks, 1)) - 1).cast("int")


def looks_like_ref(value: Column, pattern: Column | None = None) -> Column:
    """Whether a cell holds a reference and not words or a device identifier; a manufacturer's pattern can only narrow this."""
    generic = value.rlike("[0-9]") & (F.length(value) <= LONGEST_REF) & ~F.contains(value, F.lit("\n")) & ~value.startswith(OTHER_PREFIX) & ~value.rlike(PROSE)
    return generic if pattern is None else generic & F.coalesce(F.rlike(value, pattern), F.lit(True))


def refs_of_table(rows: Column, pattern: Column | None = None) -> Column:
    """The references in a table's rows of cells, the first of which is its header."""
    column = ref_column(F.get(rows, F.lit(0)))
    cells = F.transform(F.slice(rows, 2, F.greatest(F.size(rows), F.lit(1))), lambda r: _strip(F.get(r, column)))
    return F.when(column >= 0, F.filter(cells, lambda c: F.coalesce(looks_like_ref(c, pattern), F.lit(False)))).otherwise(F.array().cast(_CODES))


def _refs_in_grid(lines: Column, pattern: Column | None) -> Column:
    """References in the tables that lines make: runs of lines of equally many cells, the first of which is a header."""
    begin = F.struct(F.lit(0).alias("width"), F.lit(-1).alias("column"), F.array().cast(_CODES).alias("codes"))

    def step(acc: Column, cells: Column) -> Column:
        inside = (F.size(cells) > 1) & (F.size(cells) == acc["width"])
        cell = F.get(cells, acc["column"])
        more = F.when(inside & (acc["column"] >= 0) & F.coalesce(looks_like_ref(cell, pattern), F.lit(False)), F.array_append(acc["codes"], cell)).otherwise(acc["codes"])
        column = F.when(inside, acc["column"]).when(F.size(cells) > 1, ref_column(cells)).otherwise(-1)
        return F.struct(F.size(cells).alias("width"), column.alias("column"), more.alias("codes"))

    return F.aggregate(F.transform(lines, _cells), begin, step, lambda acc: acc["codes"])


def _refs_below_header(lines: Column) -> Column:
    """Lines that are a code each, between a line that says REF and a line of the footer."""

    def heads(line: Column) -> Column:
        line = _strip(line)
        low = F.lower(line)
        return low.startswith("ref") & (F.contains(line, F.lit("#")) | F.contains(low, F.lit("article")) | low.isin("ref", "ref no", "ref no."))

    def ends(line: Column) -> Column:
        return let(F.lower(line), lambda low: F.exists(_array(FOOTERS), lambda w: F.contains(low, w)))

    def codes(below: Column) -> Column:
        end = F.array_position(F.transform(below, ends), True).cast("int")
        block = F.when(end > 0, F.slice(below, F.lit(1), end - 1)).otherwise(below)
        return F.filter(block, lambda x: x.rlike(REF_LINE) & x.rlike("[0-9]") & ~x.rlike(DATE_LINE))

    # lambdas bind what is used more than once; lines are stripped where it can matter
    head = F.array_position(F.transform(lines, lambda x: F.when(F.contains(F.lower(x), F.lit("ref")), heads(x)).otherwise(False)), True).cast("int")
    below = lambda at: F.transform(F.slice(lines, at + 1, F.size(lines)), _strip)
    return let(head, lambda at: F.when(at > 0, let(below(at), codes)).otherwise(F.array().cast(_CODES)))


def _refs_above_label(lines: Column) -> Column:
    """Codes, and pairs of codes, in the line above a label of codes."""
    above = F.filter(F.transform(lines, lambda x, i: F.when((i > 0) & x.rlike(CODE_LABEL), F.get(lines, i - 1))), lambda x: x.isNotNull())
    halves = F.flatten(F.transform(above, lambda x: F.transform(F.split(x, "[,/]"), _strip)))
    return F.filter(halves, lambda x: x.rlike(CODE))


def _numbered(pages: Column, reader: Callable[[Column], Column], may: Callable[[Column], Column]) -> Column:
    """What a reader finds in the lines of each page that may hold something for it, with the page's number; pages without a find are left out."""
    lines = lambda p: F.split(p, _LINE_END, -1)
    read = lambda p: let(F.coalesce(p, F.lit("")), lambda p: F.when(may(p), reader(lines(p))).otherwise(F.array().cast(_CODES)))
    return F.filter(F.transform(pages, lambda p, i: F.struct(read(p).alias("codes"), (i + 1).cast("int").alias("page"))), lambda x: F.size(x["codes"]) > 0)


def reference_list(pages: Column, tables: Column | None = None, pattern: Column | None = None) -> Column:
    """(codes, page, rung): the references that a document lists, as they are printed; null if it lists none.

    Tables come first: tables, an array of (page, rows of cells), where a reader found some, and those that lines of a page
    make. Then the first page with codes below a REF header, then the first one with codes above a label of codes.
    """
    says = lambda word: lambda p: F.contains(F.lower(p), F.lit(word))
    grids = _numbered(pages, lambda x: _refs_in_grid(x, pattern), lambda p: p.rlike(r"\||\t| {2}"))
    if tables is not None:
        read = F.transform(tables, lambda t: F.struct(refs_of_table(t["rows"], pattern).alias("codes"), t["page"].cast("int").alias("page")))
        grids = F.when(tables.isNotNull(), F.concat(F.filter(read, lambda x: F.size(x["codes"]) > 0), grids)).otherwise(grids)

    def rung(found: Column, name: str, codes: Callable[[Column], Column], page: Callable[[Column], Column]) -> Column:
        made = lambda x: F.struct(F.array_distinct(codes(x)).alias("codes"), page(x).cast("int").alias("page"), F.lit(name).alias("rung"))
        return let(found, lambda x: F.when(F.size(x) > 0, made(x)))

    first = (lambda x: F.get(x, F.lit(0))["codes"]), (lambda x: F.get(x, F.lit(0))["page"])
    return F.coalesce(
        rung(grids, "table", lambda x: F.flatten(F.transform(x, lambda y: y["codes"])), lambda x: F.array_min(F.transform(x, lambda y: y["page"]))),
        rung(_numbered(pages, _refs_below_header, says("ref")), "text", *first),
        rung(_numbered(pages, _refs_above_label, says("code")), "labelled", *first),
    )


# ---- month and year

#: Month names that are no months before a year, and those that are words in lower case.
NO_MONTH_ALONE, WORDS_TOO = ("set", "out", "ago"), ("may", "march", "august")
#: What numbers of lots, pages, sets and series are called.
NUMBERED = "lot|lote|lotto|batch|charge|page|pages|pag|pagina|seite|stran|set|serie|series|serial|sn|s/n"

_GAP = r"\s{0,4}"
_NOT_NUMBERED = rf"(?<!\b(?:{NUMBERED})\.?{_GAP}(?:no\.?|nr\.?)?{_GAP}[:#]?{_GAP})"
_NO_MORE = r"(?!\s*[-/.]\s*[0-9])"


def _month_names(month: int) -> str:
    """A pattern of the names of a month; those that are words too with a capital only."""
    names = [m for m, n in MONTHS.items() if n == month and m not in NO_MONTH_ALONE]
    return "|".join(rf"(?-i:{m[0].upper()}){m[1:]}" if m in WORDS_TOO else m for m in sorted(names, key=lambda m: (-len(m), m)))


def printed_month_year(value: Column, quote: Column) -> Column:
    """Where a quote prints month and year of the first of a month (value, an ISO date), as lines about a revision do; else null.

    Not as a part of a whole date, not where the numbers are a lot's, page's or set's, and not where a name is a lower-case word.
    """
    year, month = F.substring(value, 1, 4), F.substring(value, 6, 2).try_cast("int")
    short, number = F.substring(value, 3, 2), month.cast("string")
    joined = lambda *xs: F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in xs])
    own = rf"(?i)(?<![0-9])(?<![0-9]{_GAP}[-/.]{_GAP}){_NOT_NUMBERED}"
    forms = [
        joined(own, "0?", number, r"\s*[-/._]\s*(?:", year, "|", short, ")(?![0-9])", _NO_MORE),
        joined(own, year, r"\s*[-/.]\s*0?", number, "(?![0-9])", _NO_MORE),
        joined(
            rf"(?iu)(?<![0-9](?:st|nd|rd|th)?\.?{_GAP}){_NOT_NUMBERED}\b(?:", F.element_at(F.create_map(*[F.lit(x) for m in range(1, 13) for x in (m, _month_names(m))]), month), r")\.?,?\s*", year, "(?![0-9])"
        ),
    ]
    return F.when(value.rlike("^[0-9]{4}-[0-9]{2}-01$"), F.coalesce(*[F.regexp_substr(quote, p) for p in forms]))


def printed_dates(quote: Column) -> Column:
    """The whole dates that a text prints, as (text, date)."""
    return F.filter(F.transform(F.regexp_extract_all(quote, F.lit(DATE), F.lit(0)), lambda x: F.struct(x.alias("text"), parse_printed_date(x).alias("date"))), lambda x: x["date"].isNotNull())


def printed_date(value: Column, quote: Column) -> Column:
    """The part of a quote that prints an ISO date: a whole date, the value itself, or its month and year; else null."""
    whole = F.get(F.filter(printed_dates(quote), lambda x: x["date"].cast("string") == value), F.lit(0))["text"]
    return F.coalesce(whole, F.when(F.contains(quote, value), value), printed_month_year(value, quote))
