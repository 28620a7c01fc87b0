"""What kind of document a text is: its class, type, regulation, the risk class it states, its certificate's number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlight.functions.printed import let

#: Phrases that name a type, in order of precedence where they begin at the same place.
TYPE_MARKERS = (
    ("declaration of conformity", "DoC"), ("konformitätserklärung", "DoC"), ("konformitatserklarung", "DoC"), ("izjava o skladnosti", "DoC"), ("déclaration ue de conformité", "DoC"), ("déclaration de conformité", "DoC"),
    ("declaration de conformite", "DoC"), ("dichiarazione di conformità", "DoC"), ("dichiarazione di conformita", "DoC"), ("izjava eu o skladnosti", "DoC"), ("dichiarazione ue di conformità", "DoC"), ("dichiarazione ue di conformita", "DoC"),
    ("iso 13485", "ISO"), ("ec certificate", "EC"), ("eu certificate", "EC"), ("ce certificate", "EC"), ("ukca certificate", "EC"), ("instructions for use", "IFU"), ("navodila za uporabo", "IFU"), ("gebrauchsanweisung", "IFU"),
)
#: Parts of file names that name a type, in order.
FILE_MARKERS = (("declaration", "DoC"), ("konformit", "DoC"), ("izjava", "DoC"), ("doc", "DoC"), ("13485", "ISO"), ("iso", "ISO"), ("ifu", "IFU"), ("navodila", "IFU"), ("cert", "EC"))
#: Citations of the two regulations, longest first, and what file names have of them.
CITATIONS = {"MDR": ("(eu) 2017/745", "regulation (eu) 2017/745", "2017/745"), "MDD": ("93/42/eec", "93/42/ewg", "directive 93/42", "rl 93/42", "93/42")}
FILE_CITATIONS = {"MDR": ("mdr", "2017-745", "2017_745"), "MDD": ("mdd", "93-42")}
#: Phrases of business papers, of safety data sheets, and one more of compliance documents.
BUSINESS = ("dobavnica", "račun", "racun", "ponudba", "invoice", "delivery note", "offer no", "quotation")
SAFETY = ("safety data sheet", "sicherheitsdatenblatt", "varnostni list", "msds")
IDENTIFIED = "basic udi-di"
#: Characters of a title, how sure a mention behind it and a file name are, characters of an opening and what calls itself a certificate there.
TITLE, MENTIONED, OPENING, CERTIFICATE_WORDS = 4000, 0.6, 500, ("certificat", "zertifikat", "certifikat")
#: What stands before a risk class, the classes, a list of several, devices in general, and how sure a class is.
CLASS_LABEL, CLASS_TOKEN = r"(?:risk\s+class|class|klasse|razred|classe)\s*[:/]?\s*", r"(?>II\s*a\b|II\s*b\b|III\b|I\s*s\b|I\s*m\b|I\s*r\b|I\b)"
LISTED, DEVICES, SELF, CLASS_CONFIDENCE = r"(?!\s*[/,]\s*[Il1])", r"(?!\s*(?:medical\s+|implantable\s+)?devices\b)", r"(?<=classified\s{1,9}as\s{0,9})", 0.95
#: A labelled certificate number, and one behind a bare label on a line of its own.
CERTIFICATE = r"(?i)(?:certificate\s*no|certificate\s*number|zertifikatsnr|cert\.?\s*no)\.?\s*:?\s*([A-Za-z0-9][A-Za-z0-9 /.\-]{3,40})"
BARE_NUMBER = r"(?m)^No\.[ \t]+([A-Z0-9][A-Za-z0-9 /.\-]{3,40})$"


def _texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _any(low: Column, phrases) -> Column:
    return F.exists(_texts(phrases), lambda p: F.contains(low, p))


def _folded(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+", " "))


def _base(filename: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(filename, F.lit("")), "([^/]*)$", 1))


def _evidence(value: Column, conf: Column, verbatim: Column) -> Column:
    return F.struct(value.alias("value"), conf.cast("double").alias("conf"), verbatim.alias("verbatim"))


def _complies(low: Column) -> Column:
    return _any(low, [m for m, _ in TYPE_MARKERS]) | _any(low, [*CITATIONS["MDR"], *CITATIONS["MDD"], IDENTIFIED])


def file_type(filename: Column) -> Column:
    """The type that a file's own name claims; the folders above it don't count."""
    base = _base(filename)
    return F.coalesce(*[F.when(F.contains(base, F.lit(m)), v) for m, v in FILE_MARKERS])


def file_regulation(filename: Column) -> Column:
    base = _base(filename)
    return F.coalesce(*[F.when(_any(base, parts), name) for name, parts in FILE_CITATIONS.items()])


def document_class(first_page: Column) -> Column:
    """msds, business-doc, compliance-doc or unknown, by the first page."""
    found = F.transform(F.array(_folded(first_page)), lambda low: F.when(_any(low, SAFETY), "msds").when(_any(low, BUSINESS), "business-doc").when(_complies(low), "compliance-doc").otherwise("unknown"))
    return F.get(found, F.lit(0))


def promoted_class(first_class: Column, header: Column, filename: Column) -> Column:
    """An unknown class becomes compliance-doc by what its first two pages say; where they say nothing at all, by the file's name."""
    low = _folded(header)
    named = file_type(filename).isNotNull() | file_regulation(filename).isNotNull()
    return F.when(first_class != "unknown", first_class).when(_complies(low) | ((low == "") & named), "compliance-doc").otherwise("unknown")


def document_type(text: Column, filename: Column) -> Column:
    """(value, conf, verbatim) of the earliest phrase that names a type; a cited standard only where nothing else is named. Without one, by the file's name."""
    markers = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).alias("marker"), F.lit(v).alias("value")) for i, (m, v) in enumerate(TYPE_MARKERS)])
    # lambdas bind what is used more than once; contains is faster than a search for the place
    placed = lambda low: F.transform(F.filter(markers, lambda m: F.contains(low, m["marker"])), lambda m: F.struct(F.instr(low, m["marker"]).alias("at"), m["i"], m["marker"], m["value"]))
    own = lambda hs: F.when(F.exists(hs, lambda h: h["value"] != "ISO"), F.filter(hs, lambda h: h["value"] != "ISO")).otherwise(hs)
    head = F.regexp_replace(F.lower(F.substring(text, 1, OPENING)), "ﬁ", "fi")
    by_name = _evidence(file_type(filename), F.lit(MENTIONED), F.concat(F.lit("filename:"), filename))

    def told(best: Column) -> Column:
        title = (best["at"] <= TITLE) & ((best["value"] != "ISO") | _any(head, CERTIFICATE_WORDS))
        found = _evidence(best["value"], F.when(title, 1.0).otherwise(MENTIONED), F.substring(text, best["at"], F.length(best["marker"])))
        return F.when(best.isNotNull(), found).when(file_type(filename).isNotNull(), by_name)

    return let(let(let(F.lower(text), placed), lambda hs: F.array_min(own(hs))), told)


def regulation(text: Column, filename: Column) -> Column:
    """(value, conf, verbatim) of the one regulation that is cited; null where both are; by the file's name where none is."""
    low = F.lower(F.coalesce(text, F.lit("")))
    cited = {name: _any(low, phrases) for name, phrases in CITATIONS.items()}
    quote = {name: F.coalesce(*[F.when(F.contains(low, F.lit(p)), F.substring(text, F.instr(low, F.lit(p)), F.lit(len(p)))) for p in phrases]) for name, phrases in CITATIONS.items()}
    said = lambda name: _evidence(F.lit(name), F.lit(1.0), quote[name])
    named = file_regulation(filename)
    return (
        F.when(cited["MDR"] & cited["MDD"], None).when(cited["MDR"], said("MDR")).when(cited["MDD"], said("MDD"))
        .when(named.isNotNull(), _evidence(named, F.lit(MENTIONED), F.concat(F.lit("filename:"), filename)))
    )


def stated_class(text: Column) -> Column:
    """(value, conf, verbatim) of the one risk class that a document states about itself; null where it states several or lists them, or speaks of devices of a class."""
    core = CLASS_LABEL + CLASS_TOKEN + LISTED
    labelled = let(F.lower(text), lambda low: _any(low, ("class", "klasse", "razred")))  # most texts have no label, and the pattern is tried at each character
    numeral = lambda m: F.upper(F.regexp_replace(F.regexp_replace(m, f"(?i)^{CLASS_LABEL}", ""), r"\s+", ""))
    spelt = lambda m: F.concat(F.regexp_extract(numeral(m), "^(I+)", 1), F.lower(F.regexp_extract(numeral(m), "^I+(.*)$", 1)))

    def told(found: Column) -> Column:
        one = lambda classes: F.when(F.size(classes) == 1, _evidence(F.get(classes, F.lit(0)), F.lit(CLASS_CONFIDENCE), F.get(found, F.lit(0))))
        return let(F.array_distinct(F.transform(found, spelt)), one)

    # a label begins with one of three letters, which are looked at before what stands in front of it
    return F.when(labelled, let(F.regexp_extract_all(text, F.lit(f"(?i)(?=[rck])(?:{SELF}{core}|{core}{DEVICES})"), F.lit(0)), told))


def mentions_class(text: Column) -> Column:
    return text.rlike(f"(?i){CLASS_LABEL}{CLASS_TOKEN}")


def certificate_number(text: Column, pattern: Column | None = None) -> Column:
    """(value, conf, verbatim) of the first labelled number, else of one behind a bare label, else of a manufacturer's own pattern with one group."""
    out = None
    for p in [F.lit(CERTIFICATE), F.lit(BARE_NUMBER)] + ([] if pattern is None else [pattern]):
        number = F.regexp_replace(F.trim(F.call_function("regexp_extract", text, p, F.lit(1))), r"\.+$", "")
        made = _evidence(number, F.lit(1.0), F.trim(F.regexp_substr(text, p)))
        hit = F.rlike(text, p) & (number != "")
        out = F.when(hit, made) if out is None else out.when(hit, made)
    return out
