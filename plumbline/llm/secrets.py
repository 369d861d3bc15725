"""Secret scan: fixed patterns, and candidates that stay novel to a primed zstandard compressor."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import quoted, without

# The patterns of the base kinds, and what makes their matches count.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "novel")

#: Words near which a string is sensitive, and how far before it they may stand.
SENSITIVE = re.compile(r"(?ai)pass(?:word|wd|phrase)?|secret|token|api|key|credential|auth|bearer|private|signature|session|salt")
REACH = 48
#: Strings are measured from this length on: runs of these characters, and quoted ones without blanks.
LEAST = 12
_RUN = r"[A-Za-z0-9+/_=~.$!%^*#-]"
CANDIDATE = re.compile(rf"""(?<!{_RUN}){_RUN}{{{LEAST}}}|["'`][^\s"'`]{{{LEAST}}}""")
_TAIL, _QUOTED = re.compile(rf"{_RUN}*"), re.compile(r"""[^\s"'`]*""")
#: What is left of an identifier after the sensitive word in it, marks that join it to a value, and a name before a value.
_IDENTIFIER = re.compile(r"(?:_?[A-Za-z]++(?![A-Za-z0-9]))*+[A-Za-z0-9]*+")
_JOINED, _NAME = re.compile(r"[=:&?_.~-]+"), re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*=+")
#: Text around a candidate that primes the compressor besides the identifiers.
SURROUNDINGS = 256
#: A candidate is reported if it adds so many bytes for each of its own, and so many at least.
LEAST_SHARE, LEAST_BYTES = 0.5, 10
#: The identifier dictionary: the most frequent ones of the corpus.
IDENTIFIER = r"\b(?:[A-Za-z]+(?:_[A-Za-z]+)+|[a-z]+(?:[A-Z][a-z]+)+)\b"
IDENTIFIERS = 2_000
LONGEST_IDENTIFIER = 40
_HEX_RUN = b"h" * 16
_HEX_CLASS = bytes(ord("h") if chr(i) in "0123456789abcdef" else 0 for i in range(256))
_LOWER_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_LOWER_HINTS = (b"pass", b"secret", b"token", b"api", b"key", b"credential", b"auth", b"bearer", b"private", b"signature",
                b"session", b"salt")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns, in code points.

    Cheap searches of the bytes come first; they only leave out texts that cannot match.
    """
    raw = text.encode("utf-8", "surrogatepass")
    lower, found = raw.lower(), []
    if any(word in lower for word in _LOWER_WORDS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if b"AKIA" in raw:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    if _HEX_RUN in raw.translate(_HEX_CLASS):
        found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return found


class Novelty:
    """Marginal compressed bytes of a string, given identifiers and the text around it."""

    def __init__(self, identifiers: bytes):
        words = zstandard.ZstdCompressionDict(identifiers, dict_type=zstandard.DICT_TYPE_RAWCONTENT) \
            if identifiers else None
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=words, write_content_size=False)

    def share(self, text: str, start: int, end: int) -> tuple[float, int]:
        """Added bytes per byte of ``text[start:end]``, and added bytes."""
        before, after = text[max(0, start - SURROUNDINGS):start], text[end:end + SURROUNDINGS]
        around = (before + after).encode("utf-8", "surrogatepass")
        candidate = text[start:end].encode("utf-8", "surrogatepass")
        added = len(self.compressor.compress(around + b"\n" + candidate)) - len(self.compressor.compress(around + b"\n"))
        return added / len(candidate), added


def _value(text: str, start: int) -> tuple[int, int, int]:
    """The run at ``start``, without a name and ``=`` before it or exclamation marks at its end, and where it ends with them."""
    end = whole = _TAIL.match(text, start).end()
    while end > start and text[end - 1] == "!":
        end -= 1
    name = _NAME.match(text, start, end)
    return (name.end() if name and end - name.end() >= LEAST else start), end, whole


def candidates(text: str) -> list[tuple[int, int]]:
    """Long strings joined to the identifier of a sensitive word, or starting at most ``REACH`` characters after it."""
    out, seen, known = [], 0, 0
    for hint in SENSITIVE.finditer(text):
        if hint.end() > known:  # else the word is part of the identifier before
            known = _IDENTIFIER.match(text, hint.end()).end()
            joined = _JOINED.match(text, known)
            if joined and known >= seen:
                start, end, seen = _value(text, joined.end())
                if end - start >= LEAST:
                    out.append((start, end))
        at = max(seen, known)
        while match := CANDIDATE.search(text, at, min(len(text), known + REACH + LEAST)):
            start = match.start()
            if text[start] in "\"'`":
                end = _QUOTED.match(text, match.end()).end()  # the search may have cut it
                if text[end:end + 1] != text[start]:
                    at = start + 1
                    continue
                out.append((start + 1, end))
                at = seen = end + 1
            else:
                start, end, seen = _value(text, start)
                if end - start >= LEAST:
                    out.append((start, end))
                at = seen
    return out


def scan(text: str, novelty: Novelty) -> list[dict]:
    """All spans of a text, by start and kind."""
    base = base_spans(text)
    spans = [(start, KINDS.index(kind), end, None) for start, end, kind in base]
    lower = text.encode("utf-8", "surrogatepass").lower()
    if any(hint in lower for hint in _LOWER_HINTS):
        for start, end in candidates(text):
            share, added = novelty.share(text, start, end)
            if share >= LEAST_SHARE and added >= LEAST_BYTES:
                spans.append((start, KINDS.index("novel"), end, share))
    return [{"kind": KINDS[kind], "start": start, "end": end, "share": share}
            for start, kind, end, share in sorted(spans, key=lambda s: s[:3])]


def identifier_dictionary(docs: DataFrame, text_col: str = "text") -> bytes:
    """The corpus's most frequent identifiers, the most frequent last, where zstandard finds them nearest.

    At most ``IDENTIFIERS`` of at most ``LONGEST_IDENTIFIER`` characters; counted over all texts with partial
    sums in the map tasks. Identifiers with digits are left out, as they may be secrets themselves.
    """
    found = F.regexp_extract_all(quoted(text_col).cast("string"), F.lit(IDENTIFIER), F.lit(0))
    words = docs.select(F.explode(found).alias("word")).where(F.length("word") <= LONGEST_IDENTIFIER)
    top = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(IDENTIFIERS).collect()
    return "\n".join(row.word for row in reversed(top)).encode()


def _scanner(shared, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(shared.value)
        for batch in batches:
            spans = [scan(text or "", novelty) for text in batch.column(text_at).to_pylist()]
            last = pa.array(spans, batch.schema.field(batch.num_columns - 1).type)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], last], schema=batch.schema)
    return run


def find_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with ``spans`` added: kind, start, end (code points, end exclusive) and novelty.

    The base kinds are leftmost matches of fixed patterns. A string of ``LEAST`` characters joined to the identifier
    that holds a sensitive word, or shortly after it, quoted or not, is ``novel`` if it still adds ``LEAST_SHARE`` bytes per byte to the compressed text
    around it, with the compressor primed by the corpus's identifiers. Rows are scanned where they are;
    only the bounded identifier dictionary is broadcast.

    Null and empty texts have no spans; repeated rows are scanned each; an empty table gives no rows. A
    column called ``spans`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(identifier_dictionary(docs, text_col))
    frame = without(docs, "spans").withColumn(text_col, quoted(text_col).cast("string"))
    kind = "array<struct<kind:string,start:int,end:int,share:double>>"
    frame = frame.withColumn("spans", F.lit(None).cast(kind))
    return frame.mapInArrow(_scanner(shared, frame.columns.index(text_col)), frame.schema)
