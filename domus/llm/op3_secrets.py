r"""Secret scans: fixed patterns, and dictionary-primed zstandard novelty.

``base_spans`` finds three fixed kinds by pattern. The method adds the kind ``novel``: strings of secret-like
shape that stand in a sensitive context (a name such as ``auth`` or ``private_key`` right before them, also joined to
them by ``=``; shorter strings only where the name is assigned to; bodies of private keys in PEM form) and that a
compressor can't explain. How much it can't is the marginal size of the string: bytes that zstandard needs
for context plus string, less those for the context alone, with a dictionary of common identifiers, key names and
words as primer. Ordinary identifiers, paths, repeated strings and prose cost little; random strings cost nearly
their entropy. The threshold is in bits for each character.

Spans are in code points, end exclusive. Cases: null and empty texts have no spans; texts are scanned whole;
repeated rows are scanned each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus.llm.common import table

# The base patterns and least lengths of the contract (letters of the first in either case).
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "novel")

#: Names that make the string behind them sensitive.
_NAME = (r"(?:passphrase|pwd|credential|auth|bearer|private|access|client|signing|license|session|encryption|account|"
         r"connection|webhook|cookie|password|passwd|secret|token|api|master|shared)"
         r"(?:[ _-]?(?:key|id|token|secret|string|code|pass|password)){0,3}[\"']?")
ASSIGNED = re.compile(_NAME + r"\x20{0,3}(?::=|=>|[:=]|\x20is\x20)\x20{0,3}[\"']?$", re.I | re.A)
SENSITIVE = re.compile(_NAME + r"\x20{0,3}(?::=|=>|[:=]|\x20is\x20|\x20)\x20{0,3}[\"']?$", re.I | re.A)
#: Runs of secret-like characters; each hex run of 32 or more lies in one.
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
#: Values with a digit: a ``=`` ends the name before them, and belongs to them only as padding.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{8,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
#: Least length where the name is followed by a blank only.
LONG = 20
PEM = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----")
#: What is taken for the body of a key without its end line.
PEM_LINES = re.compile(r"(?:(?:\s|\\[nr]){0,8}[A-Za-z0-9+/]{40,}={0,2})+(?:(?:\s|\\[nr]){1,8}[A-Za-z0-9+/]+={1,2})?", re.A)
PEM_BLANKS = " \t\r\n"
REACH = 64
CONTEXT = 256
MIN_BITS = 4.0

#: Primer: what code and prose near secrets is made of.
PRIMER = (
    "import from return function class public private protected static final const let var def self this null none "
    "true false string integer boolean float double array list object value default example localhost placeholder "
    "your_api_key_here changeme xxxxxxxx 0123456789 0000000000000000 1234567890 abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789abcdef https://www.example.com/index.html http://localhost:8080/api/v1/ "
    "user_name user_id client_id client_secret access_token refresh_token session_id auth_token private_key "
    "public_key connection_string database_url get_access_token set_password getClientSecret createSession "
    "application/json Content-Type Authorization: Bearer BEGIN PRIVATE KEY END CERTIFICATE os.environ process.env "
    "config settings environment variable parameter argument request response header cookie the and for with that "
).encode()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the fixed kinds, in order; leftmost and non-overlapping within a kind."""
    low, out = text.lower(), []
    if any(x in low for x in ("passw", "secret", "token", "api")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    for run in RUN.finditer(text):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text, run.start(), run.end())]
    return sorted(out)


class Novelty:
    """Marginal compressed size of strings, primed with a dictionary."""

    def __init__(self, primer: bytes = PRIMER):
        primed = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.codec = zstandard.ZstdCompressor(level=3, dict_data=primed, write_content_size=False)

    def bits(self, context: str, candidate: str) -> float:
        """Bits for each character of ``candidate`` beyond what ``context`` and the primer explain."""
        before = context.encode()
        more = len(self.codec.compress(before + candidate.encode())) - len(self.codec.compress(before))
        return 8.0 * more / len(candidate)


def key_bodies(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of what stands between the first and last line of each private key in PEM form."""
    for m in PEM.finditer(text) if "PRIVATE KEY" in text else ():
        start = m.end()
        end = text.find("-----", start)
        if end < 0 or not text.startswith("-----END", end):
            lines = PEM_LINES.match(text, start)
            end = lines.end() if lines else start
        start += len(text[start:end]) - len(text[start:end].lstrip(PEM_BLANKS))
        end = start + len(text[start:end].rstrip(PEM_BLANKS))
        if end > start:
            yield start, end


def novel_spans(text: str, taken: list[tuple[int, int, int]], novelty: Novelty,
                min_bits: float = MIN_BITS) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of incompressible strings in a sensitive context, clear of ``taken`` spans
    (a private key's body may hold some)."""
    out = [(start, 3, end) for start, end in key_bodies(text)
           if novelty.bits(text[max(0, start - CONTEXT):start] + text[end:end + CONTEXT], text[start:end]) >= min_bits]
    taken = [*taken, *out]
    for c in CANDIDATE.finditer(text):
        start, end = c.span()
        found = c.group()
        if not any(x.isalpha() for x in found):
            continue
        if not (SENSITIVE if end - start >= LONG else ASSIGNED).search(text[max(0, start - REACH):start]):
            continue
        if any(s < end and start < e for s, _, e in taken):
            continue
        around = text[max(0, start - CONTEXT):start] + text[end:end + CONTEXT]
        if novelty.bits(around, found) >= min_bits:
            out.append((start, 3, end))
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by ``[SECRET]``."""
    out, at = [], 0
    for s, _, e in sorted(spans):
        if s >= at:
            out += [text[at:s], "[SECRET]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


FINDINGS = T.StructType([T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
                         T.StructField("n_hex", T.LongType()), T.StructField("n_novel", T.LongType()),
                         T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
                         T.StructField("clean", T.StringType())])


def with_findings(docs: DataFrame, min_bits: float = MIN_BITS, redact: bool = False) -> DataFrame:
    """All rows and columns of ``docs``, and ``_findings``: counts, digest, spans and, if asked for, the text
    without its secrets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            rows = []
            for value in batch.column(batch.schema.get_field_index("text")):
                text = value.as_py()
                base = base_spans(text) if text else []
                extra = novel_spans(text, base, novelty, min_bits) if text else []
                kinds, every = [k for _, k, _ in base], sorted(base + extra)
                clean = redacted(text, every) if redact and text else text if redact else None
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2), len(extra),
                             hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), clean))
            columns = [pa.array(c, pa.int64() if k < 4 else pa.string())
                       for k, c in enumerate(zip(*rows, strict=True))] if rows else [
                pa.array([], pa.int64() if k < 4 else pa.string()) for k in range(7)]
            found = pa.StructArray.from_arrays(columns, names=FINDINGS.names)
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "_findings"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_findings", FINDINGS)]))


def scan(docs: DataFrame, min_bits: float = MIN_BITS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans of every document."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return with_findings(d, min_bits).select("doc_id", *(f"_findings.{c}" for c in FINDINGS.names[:-1]))


def without_secrets(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with the secrets in their texts replaced, and ``n_chars`` (if there) counted again."""
    clean = with_findings(docs, redact=True).withColumn("text", F.col("_findings.clean"))
    if "n_chars" in docs.columns:
        changed = F.col("_findings.spans") != ""
        clean = clean.withColumn("n_chars", F.when(changed, F.char_length("text")).otherwise(F.col("n_chars"))
                                 .cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan every whole text of ``documents`` for secrets."""
    return scan(table(spark, sf_dir, "documents"))
