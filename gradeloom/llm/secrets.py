"""Secrets: patterns and, next to words that announce them, strings that a primed compressor finds new."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from gradeloom.llm.shipping import ship

KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # as a run is taken whole, the same as dropping shorter runs
#: A word that announces a secret.
SENSITIVE = re.compile(
    r"secret|token|credential|passw|passphrase|api.?key|access.?key|private.?key|auth|bearer|client.?id", re.I | re.A)
#: Runs of characters that secrets are made of, joined by single dots, and what is left of a run from a place on.
RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
RUNS = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]+(?:\.[A-Za-z0-9+/_=-]+)*")
REST = re.compile(r"[A-Za-z0-9+/_=-]*")
#: Characters between the word that announces, or a string measured before, and the next one of the line to be
#: measured; characters of such a string at least.
REACH, LEAST_LENGTH = 24, 16
#: Any of these in a text, in lower case, is needed for a match of ASSIGN or SENSITIVE.
NEEDED = ("passw", "passphrase", "secret", "token", "key", "credential", "auth", "bearer", "client")
#: Names that are ordinary in code and prose around secrets; the compressor knows them beforehand.
DICTIONARY = (
    "the of and to in is that for with as by from on this was are it at or an be not have which one all their has "
    "value name type string number token_type token_name secret_name secret_key_base api_key_name access_key_id "
    "client_id client_secret password_hash password_reset_token authorization_header Bearer authentication required "
    "get_access_token refresh_token set_password validate_credentials public_key private_key_path session_token "
    "configuration environment variable example placeholder changeme your-api-key-here xxxxxxxxxxxxxxxx "
    "AAAAAAAAAAAAAAAA 0000000000000000 1234567890123456 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ "
    "application/json content-type https://www.example.com/index.html http request response header parameter "
    "function return import export default undefined null true false self this class public static final void"
).encode()
#: Characters of surrounding text that the compressor sees before the candidate.
SURROUNDINGS = 400
#: A candidate is reported if it costs this many compressed bytes for each of its characters.
LEAST_NOVELTY = 0.6


def novelty(compressor: zstandard.ZstdCompressor, around: bytes, candidate: bytes) -> float:
    """Compressed bytes that the candidate adds to its surroundings, by character."""
    more = len(compressor.compress(around + candidate)) - len(compressor.compress(around))
    return more / len(candidate)


def announced(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of the dotted runs behind announcing words, in order, each once."""
    at = 0  # behind the last run looked at, or the one a word ends in
    for m in SENSITIVE.finditer(text):
        if m.end() > at:
            at = REST.match(text, m.end()).end()
        reach = max(m.end(), at) + REACH
        while (run := RUNS.search(text, at)) and run.start() <= reach and text.find("\n", at, run.start()) < 0:
            at = run.end()
            if run.end() - run.start() >= LEAST_LENGTH:
                reach = at + REACH
                yield run.span()


def secret_spans(text: str, compressor: zstandard.ZstdCompressor) -> list[tuple[int, int, int, float]]:
    """(start, end, kind, novelty) by start, then kind; 3 is the method's own kind, base kinds have novelty -1."""
    found = [(m.start(), m.end(), 2, -1.0) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1, -1.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    low = text.lower()
    if any(word in low for word in NEEDED):
        found += [(m.start(), m.end(), 0, -1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        base = sorted(x[:2] for x in found)
        starts, reach = [a for a, _ in base], list(accumulate((b for _, b in base), max))

        def measured(start: int, end: int) -> bool:
            word = text[start:end]
            if end - start < LEAST_LENGTH or not (re.search("[0-9]", word) and re.search("[A-Za-z]", word)):
                return False
            before = bisect_left(starts, end)  # spans that start before the end
            if before and reach[before - 1] > start:
                return False
            # the candidate's own repeats nearby don't make it known
            around = text[max(0, start - SURROUNDINGS):start] + "\n" + text[end:end + SURROUNDINGS] + "\n"
            new = novelty(compressor, around.replace(word, "").encode("utf-8", "replace"), word.encode())
            if new >= LEAST_NOVELTY:
                found.append((start, end, 3, new))
            return new >= LEAST_NOVELTY

        for start, end in announced(text):
            # a secret may be all of a dotted name or one part of it
            if not measured(start, end) and "." in text[start:end]:
                for run in RUN.finditer(text, start, end):
                    measured(*run.span())
    return sorted(found, key=lambda x: (x[0], x[2]))


SPANS = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.float64())])
SPANS_DDL = "array<struct<kind:string,start:bigint,end:bigint,novelty:double>>"


def find_secrets(docs: DataFrame, columns: list[str], redact: str | None = None) -> DataFrame:
    """The rows of `docs` with their secrets: `found`, an array of (kind, start, end, novelty).

    `columns` are kept as they are; text is read from the column text. With `redact`, the column text comes
    back with each secret replaced by that string, where spans overlap from the first start to the last end.
    Places are code points of the whole text, by start and then kind. Null and empty texts have none (and
    stay null or empty); equal rows are answered one by one; no rows give no rows. One pass, no shuffle.
    """
    ship(docs.sparkSession)
    names = [*KINDS, "novel"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(
            DICTIONARY, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        for batch in batches:
            found, texts = [], []
            for value in batch.column(batch.num_columns - 1):
                text = value.as_py()
                spans = secret_spans(text or "", compressor)
                found.append([{"kind": names[k], "start": a, "end": b, "novelty": new} for a, b, k, new in spans])
                if redact is not None:
                    texts.append(cut(text, spans, redact))
            out = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(
                out + ([pa.array(texts, pa.string())] if redact is not None else []) + [pa.array(found, pa.list_(SPANS))],
                names=[*columns, *(["text"] if redact is not None else []), "found"])

    fields = [docs.schema[c] for c in columns]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    kept = docs.select(*columns, docs["text"].alias("_text"))
    return kept.mapInArrow(run, f"{ddl}, {'text string, ' if redact is not None else ''}found {SPANS_DDL}")


def cut(text: str | None, spans: list[tuple[int, int, int, float]], by: str) -> str | None:
    if not spans:
        return text
    parts, at, open_ = [], 0, None
    for start, end, *_ in spans:
        if open_ is not None and start < open_[1]:
            open_[1] = max(open_[1], end)
            continue
        if open_ is not None:
            parts += [text[at:open_[0]], by]
            at = open_[1]
        open_ = [start, end]
    return "".join([*parts, text[at:open_[0]], by, text[open_[1]:]])


def secrets_digest(docs: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans and all spans as text, one row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(1).to_pylist()
            base = [[x for x in spans if x["kind"] in KINDS] for spans in found]
            said = lambda spans: ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in spans)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *(pa.array([sum(x["kind"] == k for x in b) for b in base], pa.int64()) for k in KINDS),
                pa.array([hashlib.sha256(said(b).encode()).hexdigest() for b in base], pa.string()),
                pa.array([said(spans) for spans in found], pa.string()),
            ], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    digest = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return find_secrets(docs, ["doc_id"]).mapInArrow(run, digest)
