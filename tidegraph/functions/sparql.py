"""SPARQL 1.1 built-ins where Spark's functions differ; errors are unbound, that is null.

Functions that agree are used as they are: length, substring, upper, lower,
startswith, endswith, contains, concat, abs, md5, sha1, sha2, rlike.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

XSD = "http://www.w3.org/2001/XMLSchema#"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strbefore(s: Column | str, d: str) -> Column:
    """Empty if d does not occur; substring_index alone would give all of s."""
    return F.when(F.instr(_c(s), d) > 0, F.substring_index(_c(s), d, 1)).when(_c(s).isNotNull(), "")


def strafter(s: Column | str, d: str) -> Column:
    at = F.instr(_c(s), d)
    return F.when(at > 0, _c(s).substr(at + F.length(F.lit(d)), F.length(_c(s)))).when(_c(s).isNotNull(), "")


def encode_for_uri(s: Column | str) -> Column:
    """Percent encoding that leaves only unreserved characters; url_encode makes forms instead."""
    out = F.url_encode(_c(s))
    for one, other in (("+", "%20"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(one), F.lit(other))
    return out


def lang_matches(tag: Column | str, wanted: str) -> Column:
    if wanted == "*":
        return F.length(_c(tag)) > 0
    return (F.lower(_c(tag)) == wanted.lower()) | F.lower(_c(tag)).startswith(wanted.lower() + "-")


def regex(s: Column | str, pattern: str, flags: str = "") -> Column:
    """Flags s, m, i, x as Java's inline flags; q quotes the pattern."""
    if "q" in flags:
        pattern = "\\Q" + pattern.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    inline = "".join(f for f in flags if f in "smix")
    return _c(s).rlike(f"(?{inline}){pattern}" if inline else pattern)


def replace(s: Column | str, pattern: str, by: str, flags: str = "") -> Column:
    inline = "".join(f for f in flags if f in "smix")
    return F.regexp_replace(_c(s), f"(?{inline}){pattern}" if inline else pattern, by)


def _whole(x: Column, to_long: Column) -> Column:
    """to_long, but NaN, infinities and numbers of 2^52 and more, which have no fraction, stay as they are."""
    return F.when(F.isnan(x) | (F.abs(x) >= float(1 << 52)), x).otherwise(to_long.cast("double"))


def round_half_up(x: Column | str) -> Column:
    """Halves go up, so -2.5 becomes -2; the fraction is looked at, since adding a half would round first."""
    x = _c(x).cast("double")
    return _whole(x, F.floor(x) + (x - F.floor(x) >= 0.5).cast("long"))


def ceil(x: Column | str) -> Column:
    x = _c(x).cast("double")
    return _whole(x, F.ceil(x))


def floor(x: Column | str) -> Column:
    x = _c(x).cast("double")
    return _whole(x, F.floor(x))


def equals(a: Column | str, b: Column | str) -> Column:
    """NaN equals nothing, itself included."""
    return (_c(a) == _c(b)) & ~F.isnan(_c(a))


def divide(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(_c(a), _c(b))


def cast(x: Column | str, datatype: str) -> Column:
    """xsd casts; what can't be cast is unbound."""
    kind = datatype.removeprefix(XSD).removeprefix("xsd:")
    if kind == "dateTime":
        # by way of an instant, so that an offset counts; the session's zone must be UTC
        return _c(x).try_cast("timestamp").cast("timestamp_ntz")
    kinds = {"boolean": "boolean", "double": "double", "float": "float", "decimal": "decimal(38,18)", "integer": "bigint", "string": "string"}
    return _c(x).try_cast(kinds[kind])


def seconds(x: Column | str) -> Column:
    return F.extract(F.lit("SECOND"), _c(x)).cast("double")


def timezone_of(lexical: Column | str) -> Column:
    """TZ of a dateTime's lexical form: Z, an offset, or empty."""
    return F.regexp_extract(_c(lexical), r"(Z|[+-]\d{2}:\d{2})$", 1)


#: What a backslash and a letter stand for in the text of a literal.
ESCAPES = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


def unescape(s: Column | str) -> Column:
    """N-Triples escapes, those of code points included, replaced by what they stand for."""
    text = _c(s)

    def plain(token: Column) -> Column:
        code = F.decode(F.unhex(F.lpad(F.substring(token, 3, 8), 8, "0")), "UTF-32")
        out = F.when(token.rlike(r"^\\[uU]"), code)
        for letter, stands_for in ESCAPES.items():
            out = out.when(token == "\\" + letter, stands_for)
        return out.otherwise(token)

    tokens = F.regexp_extract_all(text, F.lit(r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|(?s:\\.)|[^\\]++"), F.lit(0))
    return F.when(text.contains("\\"), F.array_join(F.transform(tokens, plain), "")).otherwise(text)


def escape(s: Column | str) -> Column:
    """The text of a literal in canonical N-Triples, where only four characters are escaped."""
    out = _c(s)
    for one, other in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(one), F.lit(other))
    return out


def canonical(term: Column | str) -> Column:
    """A term in canonical N-Triples: no escapes but the four of literals, language tags in small letters, xsd:string left out."""
    t = _c(term)
    suffix = F.regexp_extract(t, _LITERAL, 2)
    suffix = F.when(suffix == f"^^<{XSD}string>", "").when(suffix.startswith("@"), F.lower(suffix)).otherwise(unescape(suffix))
    literal = F.concat(F.lit('"'), escape(unescape(F.regexp_extract(t, _LITERAL, 1))), F.lit('"'), suffix)
    return F.when(t.startswith('"'), literal).when(t.startswith("<"), unescape(t)).otherwise(t)


_LITERAL = r'(?s)^"(.*)"(@[A-Za-z0-9-]+|\^\^<[^>]*>)?$'


def lexical(term: Column | str) -> Column:
    """STR of a term in N-Triples form, without its escapes; a blank node has none."""
    t = _c(term)
    return F.when(t.startswith("<"), unescape(F.regexp_extract(t, r"^<(.*)>$", 1))).when(t.startswith('"'), unescape(F.regexp_extract(t, _LITERAL, 1)))


_PARTS = re.compile(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?", re.DOTALL)


def _without_dots(path: Column) -> Column:
    """The path with its . and .. segments resolved; what they end in is a folder."""
    parts = F.split(path, "/")

    def step(done: Column, part: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done)
        return F.when(part == ".", done).when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    folder = F.element_at(parts, -1).isin(".", "..")
    return F.concat(F.array_join(kept, "/"), F.when(folder, "/").otherwise(""))


def _resolved(text: Column, base: str) -> Column:
    """A reference against a base, part by part."""
    scheme, authority, path, asked = _PARTS.fullmatch(base).groups()
    root = (f"{scheme}:" if scheme else "") + (f"//{authority}" if authority is not None else "")
    whole = root + path + (f"?{asked}" if asked is not None else "")
    tail = F.regexp_extract(text, r"(?s)^[^?#]*(.*)$", 1)
    own = F.regexp_extract(text, r"(?s)^([^?#]*)", 1)
    folder = path.rpartition("/")[0] + "/" if "/" in path or authority is not None else ""
    merged = F.when(own.startswith("/"), own).otherwise(F.concat(F.lit(folder), own))
    found = F.when(text.startswith("//"), F.concat(F.lit(f"{scheme}:" if scheme else ""), text)).when(own != "", F.concat(F.lit(root), _without_dots(merged), tail))
    return found.when(text.startswith("?"), F.concat(F.lit(root + path), text)).otherwise(F.concat(F.lit(whole), text))


def iri(s: Column | str, base: str = "") -> Column:
    """IRI of a text; one without a scheme is resolved against base, if there is one."""
    text = _c(s)
    whole = F.when(text.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), text).otherwise(_resolved(text, base) if base else text)
    return F.when(~whole.rlike(r'[<>"{}|^`\\\x00-\x20]'), F.concat(F.lit("<"), whole, F.lit(">")))


def bnode(s: Column | str) -> Column:
    """BNODE of a text: the same blank node for the same text."""
    return F.concat(F.lit("_:b"), F.substring(F.sha2(_c(s), 256), 1, 32))


def str_dt(s: Column | str, datatype_iri: str) -> Column:
    return canonical(F.concat(F.lit('"'), escape(s), F.lit(f'"^^<{datatype_iri}>')))


def str_lang(s: Column | str, tag: Column | str) -> Column:
    """STRLANG; a tag that is none gives unbound. tag is text or a column."""
    tag = F.lit(tag) if isinstance(tag, str) else tag
    return F.when(tag.rlike(r"^[A-Za-z]+(-[A-Za-z0-9]+)*$"), F.concat(F.lit('"'), escape(s), F.lit('"@'), F.lower(tag)))


def same_term(a: Column | str, b: Column | str) -> Column:
    """Terms are one if their canonical texts are."""
    return canonical(a) == canonical(b)


def lang(term: Column | str) -> Column:
    t = _c(term)
    return F.when(t.startswith('"'), F.regexp_extract(t, r'(?s)^".*"@([A-Za-z0-9-]+)$', 1))


def datatype(term: Column | str) -> Column:
    """The datatype's IRI; language-tagged and plain literals have their standard ones."""
    t = _c(term)
    own = F.regexp_extract(t, r'(?s)^".*"\^\^<([^>]*)>$', 1)
    tagged = lang(t) != ""
    return F.when(t.startswith('"'), F.when(own != "", own).when(tagged, "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString").otherwise(XSD + "string"))


def is_iri(term: Column | str) -> Column:
    return _c(term).startswith("<")


def is_blank(term: Column | str) -> Column:
    return _c(term).startswith("_:")


def is_literal(term: Column | str) -> Column:
    return _c(term).startswith('"')


NUMERIC = (
    "integer", "decimal", "double", "float", "long", "int", "short", "byte",
    "nonPositiveInteger", "negativeInteger", "nonNegativeInteger", "positiveInteger", "unsignedLong", "unsignedInt", "unsignedShort", "unsignedByte",
)


def is_numeric(term: Column | str) -> Column:
    """By datatype, and only if the text is a number."""
    return datatype(term).isin([XSD + n for n in NUMERIC]) & lexical(term).try_cast("double").isNotNull()


def term_order(term: Column | str) -> list[Column]:
    """ORDER BY over mixed terms: unbound, blank nodes, IRIs, literals; numbers by value."""
    t = _c(term)
    rank = F.when(t.isNull(), 0).when(is_blank(t), 1).when(is_iri(t), 2).otherwise(3)
    return [rank, F.when(is_numeric(t), lexical(t).try_cast("double")).asc_nulls_last(), t.asc_nulls_first()]
