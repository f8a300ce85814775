"""Secret scans: fixed patterns, and strings that surrounding code does not explain.

A string near a sensitive word, before or behind it, is a candidate, and so is one near a novel string. What it costs is measured with zstandard: the
surrounding text is compressed alone and with the candidate behind it, by a compressor that is
primed with a dictionary of identifiers. The difference is the candidate's marginal size. Prose
and identifiers repeat pieces of what is already there and cost little; a key does not, and is
reported as `novel`. Copies of the candidate nearby are taken out of its surroundings first.

Every text is scanned whole, in the task that reads it: there is no shuffle, and memory holds one
Arrow batch. Time grows with a text's length, however many spans are in it.
Defined cases: a NULL text is the empty text; an empty table gives no rows; repeated rows are scanned one by one;
columns besides id and text are passed through by `redact_secrets` and not looked at otherwise.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from salesloom.llm.common import shipped

KINDS = ("assign", "access", "hex", "novel")
# The patterns of the contract. The two runs are maximal, so a least length in the
# pattern finds the same spans as a later check of the length would.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_VALUE_LENGTH = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

SENSITIVE = re.compile(
    r"passw(?:or)?d?|passphrase|pwd|secret|token|credential|bearer|authorization|private.?key|access.?key|api.?key|signing.?key|client.?key",
    re.ASCII | re.IGNORECASE,
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]+=*")
# A key's last line, which may be short, before the line that closes the key.
LAST_LINE = re.compile(r"(?:[\r\n]|\\[rn])+\x20*([A-Za-z0-9+/]{1,15}=*)(?=(?:\s|\\[rn])*-----END)", re.ASCII)
# What a match holds for certain: quick searches for these skip the patterns where nothing can be found.
ASSIGN_PARTS = ("passw", "secret", "token", "key")
SENSITIVE_PARTS = ("passw", "passphrase", "pwd", "secret", "token", "credential", "bearer", "authorization", "key")
_HEX_MARKS = bytes(ord("h") if chr(b) in "0123456789abcdef" else ord(" ") for b in range(256))
_HEX_RUN = b"h" * 24
IDENTIFIERS = """
    access_key access_token account admin api_key apikey application argument array assert async auth authorization await
    base64 bearer boolean break bytes callback class client client_id client_secret config connection const content context
    continue cookie count credentials data database debug decode default delete description digest document email encode
    encoding endpoint environment error event example exception export false file filename float format function global
    handler hash header headers host http https import include index input instance integer interface json key label length
    license local localhost login logger message method module name namespace null number object option output package
    parameter params parse passphrase passwd password path payload pointer port private private_key process property
    protected proxy public public_key query random read redirect refresh_token region register release request required
    response result return root schema secret secret_key select self send server service session setting sha256 signature
    size source ssh static status string struct super table target template test text thread throw timeout timestamp token
    true type undefined unsigned update upload user username util value variable vector version void webhook website window
    write yaml
"""


@dataclass(frozen=True)
class Novelty:
    """`reach`: characters between a candidate and a sensitive word, or a novel string that it continues. `length`: least characters of
    a candidate. `around`: characters of text on either side that may explain it. `bytes_per_character`:
    marginal size from which on a string is novel."""

    reach: int = 48
    length: int = 16
    around: int = 300
    bytes_per_character: float = 0.7


class Scanner:
    def __init__(self, novelty: Novelty, identifiers: str = IDENTIFIERS):
        self.novelty = novelty
        primed = zstandard.ZstdCompressionDict(" ".join(identifiers.split()).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False)

    def marginal_bytes(self, text: str, start: int, end: int) -> int:
        """What the string at start:end adds to its compressed surroundings."""
        string, around = text[start:end], self.novelty.around
        near = (text[max(0, start - around) : start] + " " + text[end : end + around]).replace(string, " ")
        near_bytes = (near + "\n").encode("utf-8", "replace")
        return len(self.compressor.compress(near_bytes + string.encode())) - len(self.compressor.compress(near_bytes))

    def base_spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) by place, then kind."""
        found, lower = [], text.lower()
        if any(part in lower for part in ASSIGN_PARTS):
            values = ((m, m.end(2) - m.start(2)) for m in ASSIGN.finditer(text))
            found += [(m.start(), 0, m.end()) for m, length in values if length >= ASSIGN_VALUE_LENGTH]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
        if _HEX_RUN in text.encode("utf-8", "replace").translate(_HEX_MARKS):
            found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(found)

    def seeds(self, text: str) -> Iterator[tuple[int, int]]:
        """Strings that start within reach after a sensitive word, each once."""
        done = 0
        for word in SENSITIVE.finditer(text):
            for m in CANDIDATE.finditer(text, max(done, word.end())):
                if m.start() > word.end() + self.novelty.reach:
                    break
                done = m.end()
                if m.end() - m.start() >= self.novelty.length:
                    yield m.start(), m.end()

    def strings(self, text: str) -> tuple[list[tuple[int, int]], list[bool]]:
        """Long strings by place, apart from each other, and which of them are within reach of a sensitive word, on either
        side of it; nothing if there is no such word."""
        lower = text.lower()
        if not any(part in lower for part in SENSITIVE_PARTS):
            return [], []
        reach, length = self.novelty.reach, self.novelty.length
        runs = [m.span() for m in CANDIDATE.finditer(text) if m.end() - m.start() >= length]
        ends, before = [end for _, end in runs], []
        for word in SENSITIVE.finditer(text):
            for i in range(bisect_left(ends, word.start() - reach), len(runs)):
                if runs[i][0] >= word.start():
                    break
                before.append((runs[i][0], min(runs[i][1], word.start())))
        out: dict[tuple[int, int], bool] = {}
        for near, spans in ((True, list(self.seeds(text))), (True, before), (False, runs)):
            taken = sorted(out)
            for start, end in spans:
                i = bisect_left(taken, (end, end))
                if end - start >= length and not (i and taken[i - 1][1] > start):
                    out[start, end] = near
            out = dict(sorted(out.items()))
        return self._apart(out)

    @staticmethod
    def _apart(spans: dict[tuple[int, int], bool]) -> tuple[list[tuple[int, int]], list[bool]]:
        """Of spans by place, those that start behind all before them."""
        at, kept = 0, []
        for span in spans:
            if span[0] >= at:
                kept.append(span)
                at = span[1]
        return kept, [spans[span] for span in kept]

    def scan(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], float]:
        """Base spans, novel spans apart from them, and the highest marginal size per character. A novel string puts the
        next string on either side within reach as well, so that a secret of several lines or parts goes on."""
        base, novel, highest = self.base_spans(text), [], 0.0
        spans, near = self.strings(text)
        waiting, asked, reach = [i for i, x in enumerate(near) if x], list(near), self.novelty.reach
        starts, reached = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))

        def free(start: int, end: int) -> bool:
            """Whether no base span meets this one: of those that start before its end, none ends behind its start."""
            i = bisect_left(starts, end)
            return i == 0 or reached[i - 1] <= start

        while waiting:
            i = waiting.pop()
            start, end = spans[i]
            novelty = self.marginal_bytes(text, start, end) / (end - start)
            highest = max(highest, novelty)
            if novelty < self.novelty.bytes_per_character:
                continue
            rest = LAST_LINE.match(text, end)
            for a, b in [(start, end), *([rest.span(1)] if rest else [])]:
                if free(a, b):
                    novel.append((a, 3, b))
            for k in (i - 1, i + 1):
                if 0 <= k < len(spans) and not asked[k] and max(spans[k][0] - end, start - spans[k][1]) <= reach:
                    asked[k] = True
                    waiting.append(k)
        return base, sorted(novel), highest


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


REPORT = (
    "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_novel bigint, novelty double"
)


def secret_report(docs: DataFrame, novelty: Novelty | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: numbers of spans by kind, all spans as kind:start:end in code points, and a digest of the base ones."""
    novelty = novelty or Novelty()
    source = shipped(docs).select(id_column, text_column)
    id_type = source.schema[0].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(novelty)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, novel, highest = scanner.scan(text or "")
                kinds = [kind for _, kind, _ in base]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*[kinds.count(k) for k in range(3)], digest, joined(base + novel), len(novel), highest))
            types = [pa.int64()] * 3 + [pa.string(), pa.string(), pa.int64(), pa.float64()]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_column, *[x.split()[0] for x in REPORT.split(", ")]])

    return source.mapInArrow(scan, f"`{id_column}` {id_type}, {REPORT}")


def redact_secrets(docs: DataFrame, novelty: Novelty | None = None, mark: str = "[SECRET]") -> DataFrame:
    """The same rows with every span replaced by a mark; `n_chars` follows the text, clean rows stay as they are."""
    novelty = novelty or Novelty()
    names = docs.columns

    def clean(scanner: Scanner, text: str | None) -> str | None:
        if not text:
            return text
        base, novel, _ = scanner.scan(text)
        parts, at = [], 0
        for start, _, end in sorted(base + novel):
            if start >= at:
                parts += [text[at:start], mark]
            at = max(at, end)
        return "".join(parts) + text[at:] if parts else text

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(novelty)
        for batch in batches:
            i = names.index("text")
            before = batch.column(i).to_pylist()
            after = [clean(scanner, text) for text in before]
            columns = list(batch.columns)
            columns[i] = pa.array(after, batch.schema.field(i).type)
            if "n_chars" in names:
                k = names.index("n_chars")
                sizes = batch.column(k).to_pylist()
                sizes = [n if a is b else len(a) for n, a, b in zip(sizes, after, before, strict=True)]
                columns[k] = pa.array(sizes, batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return shipped(docs).mapInArrow(redact, docs.schema)
