"""Secret scans: fixed patterns, and dictionary-primed compression novelty for what they miss.

A candidate is a long run of key characters shortly after a sensitive word. Its
novelty is the number of bytes it adds when it is compressed inside its
surroundings by zstandard primed with a dictionary of identifiers. Code and
prose repeat what stands around them or in the dictionary; keys do not.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.llm.common import Query, schema, slices, table, whole_text

# The patterns of the base kinds and the least length of what counts.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = ("key", "secret", "passw", "pwd", "token", "auth", "bearer", "credential", "private", "signature")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
REACH = 48
# What may stand between the parts of one key: line ends, also escaped ones, dots and quotes with the blanks around.
JOINT = re.compile(r"""[ \t+,]{0,64}(?:[.\r\n"'`]|\\[rn]?)(?:[.\r\n"'` \t+,]|\\[rn]?){0,64}""")
# The last line of a key block may be shorter than a candidate.
REMAINDER = re.compile(JOINT.pattern + r"([A-Za-z0-9+/_=-]{1,19})(?=" + JOINT.pattern + "-----END)")
AROUND = 512
LEAST_NOVELTY = 0.7

# Names that code is full of; they prime the compressor.
IDENTIFIERS = """
authentication authorization access_token refresh_token client_id client_secret private_key public_key api_key
secret_key session_id user_id username password config configuration environment variable settings default
parameter argument function return string integer boolean value values index length count buffer message
request response header content_type application/json https://www. http:// localhost connection database
repository service controller handler manager factory interface implementation exception error warning
import export include require module package class public static void const let var def self this null none
true false undefined timestamp created_at updated_at description example placeholder your_key_here changeme
"""


@functools.lru_cache(maxsize=1)
def _compressor():
    import zstandard

    primed = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_checksum=False)


def novelty(before: str, candidate: str, after: str) -> float:
    """Bytes that the candidate adds to its compressed surroundings, per byte of its own."""
    size = lambda s: len(_compressor().compress(s.encode()))
    return (size(before + candidate + after) - size(before + after)) / len(candidate)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches, kinds by their place in KINDS."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def novel_spans(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Incompressible runs after a sensitive word, or directly after a part that has one, that touch no known span."""
    low = text.lower()
    if not any(w in low for w in SENSITIVE):
        return []
    found, rest, i, last = [], [], 0, -1
    for m in CANDIDATE.finditer(text):
        while i < len(known) and known[i][2] <= m.start():
            if KINDS[known[i][1]] != "hex":  # digests need no sensitive word
                last = max(last, known[i][2])
            i += 1
        if any(s < m.end() and m.start() < e for s, _, e in known[i : i + 8]):
            continue
        lead = text[max(0, m.start() - REACH) : m.start()].lower()
        follows = last >= 0 and JOINT.fullmatch(text, last, m.start())
        if not follows and not any(w in lead for w in SENSITIVE):
            rest.append(m)
            continue
        last = m.end()  # a part just below the bound doesn't end the run
        if novelty(*_surroundings(text, m)) >= LEAST_NOVELTY:
            found.append((m.start(), 3, m.end()))
            if short := REMAINDER.match(text, last):
                found.append((short.start(1), 3, short.end(1)))
    # A key is one wherever else it stands.
    keys = {text[s:e] for s, _, e in found if e - s >= 20}
    return sorted(found + [(m.start(), 3, m.end()) for m in rest if m[0] in keys])


def _surroundings(text: str, m: re.Match) -> tuple[str, str, str]:
    """What stands before and after a candidate, without the candidate's other occurrences, and itself between."""
    reach = AROUND + len(m[0])  # an occurrence that the bound cuts goes too
    before = text[max(0, m.start() - reach) : m.start()].replace(m[0], "")
    after = text[m.end() : m.end() + reach].replace(m[0], "")
    return before[-AROUND:], m[0], after[:AROUND]


def scan(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Spans of secrets, one row per row of ``docs``.

    Columns: the id, ``n_assign``, ``n_access``, ``n_hex``, ``n_novel`` (long),
    ``base_sha256`` and ``spans`` (kind:start:end by start and kind, joined by
    commas; code points, end exclusive). Null and empty texts have no spans.
    """
    texts = docs.select(F.col(id_column).alias("id"), whole_text().alias("text"))
    out = schema(
        texts, ["id"], "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long"
    )
    return texts.mapInArrow(_scanner, out).withColumnRenamed("id", id_column)


def _scanner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    joined = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"]
    for batch in slices(batches, "text"):
        rows = []
        for value in batch.column("text"):
            text = value.as_py()
            base = base_spans(text)
            novel = novel_spans(text, base)
            counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
            digest = hashlib.sha256(joined(base).encode()).hexdigest()
            rows.append((*counts, digest, joined(sorted(base + novel)), len(novel)))
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", *names])


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every span in ``text`` replaced by a mark; a null text stays null.

    Overlapping spans are replaced together.
    """
    names, at = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = pa.array([t.as_py() and _redacted(t.as_py(), mark) for t in batch.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], texts, *batch.columns[at + 1 :]], names=names)

    return docs.mapInArrow(run, docs.schema)


def _redacted(text: str, mark: str) -> str:
    base = base_spans(text)
    parts, done = [], 0
    for start, _, end in sorted(base + novel_spans(text, base)):
        if start >= done:
            parts += [text[done:start], mark]
        done = max(done, end)
    return "".join([*parts, text[done:]])


QUERIES = {"op2_secrets": Query(lambda spark, sf_dir: scan(table(spark, sf_dir, "documents")))}
