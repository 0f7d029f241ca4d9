"""Find secrets in texts: fixed patterns, and values that are hard to guess.

The patterns give the base spans. The method looks at values in a credential context
that the patterns do not cover (``pwd: ...``, ``Bearer ...``, ``user:...@host``), and at
those that they do, there with the symbols that end the patterns' values. A dynamic
programme finds the cheapest way to guess a value: it is cut into known words, dates,
repeats, keyboard walks and brute-force spans, each with the logarithm of its number of
guesses. A value whose cheapest cut still takes ``MIN_GUESSES`` (log10) is a secret and
adds a span; ``password = changeme`` does not. Letters whose pairs are those of words cost
a word of a dictionary, in every value, which keeps out prose. Addresses, and names in
code that are not quoted (``request.headers.get('x')``), are as hard as their hardest part.

All work is inside one row: no shuffle, and an executor's loss costs its tasks only.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Patterns of the base spans, in the order of their kinds.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")
LEAST_VALUE, LEAST_ACCESS = 6, 20

#: Credential contexts with values of any characters; the last group is the value. The
#: first has the names of ``ASSIGN``: a quoted value ends at its quote.
CONTEXTS = (
    re.compile(
        r"(password|passwd|secret|token|api[_-]?key)[\"']?\x20*[:=]\x20*"
        r"(?:\"((?:[^\s\"\\]|\\\S)+)|'((?:[^\s'\\]|\\\S)+)|(\S+))",
        re.IGNORECASE | re.ASCII,
    ),
    re.compile(
        r"(?<![a-z0-9])(pwd|passphrase|passcode|pass|private_?key|access_?key|client_?key|"
        r"signing_?key|credentials?|auth)[\"']?\x20*[:=]\x20*[\"']?([!-~]+)",
        re.IGNORECASE | re.ASCII,
    ),
    re.compile(r"\b(bearer|basic)\x20+([A-Za-z0-9+/_.=~-]+)", re.IGNORECASE | re.ASCII),
    re.compile(r"://([A-Za-z0-9._%+-]+):([!-.0-?A-~]+)(?=@)"),
)
#: What a context contains, lower-case: texts without it are not searched.
HINTS = re.compile(r"pwd|pass|secret|token|key|cred|auth|bearer|basic|://", re.IGNORECASE)
ASSIGN_HINTS = re.compile(r"passw|secret|token|api", re.IGNORECASE)

#: Smallest number of guesses (log10) of a secret, that of eight unrelated digits.
MIN_GUESSES = 8.0
#: Kind of the spans that the method adds.
GUESS = "guess"

#: Words that people put into passwords, commonest first.
WORDS = (
    "password pass admin user root test login welcome secret token default guest master "
    "changeme change me letmein let monkey dragon football baseball soccer hockey shadow sunshine "
    "princess superman batman iloveyou love hello freedom whatever trustno trust flower summer "
    "winter spring autumn monday friday january june july august october december example sample "
    "demo value none null true false your my key api the and for this that with pass word pwd "
    "passwd server system database data mysql postgres oracle public private access client "
    "service account company office internet computer google apple money angel baby lovely "
    "michael jennifer jordan charlie thomas robert daniel andrew joshua matthew ashley nicole "
    "jessica george harley ranger hunter killer pepper cookie cheese coffee orange banana purple "
    "yellow silver golden diamond star king queen tiger lion eagle falcon phoenix mustang"
).split()
RANK = {w: i + 1 for i, w in reversed(list(enumerate(WORDS)))}
LONGEST = max(map(len, WORDS))
SWAPS = str.maketrans("@4831!05$7", "aabeliosst")
#: Rows of a keyboard.
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz")
STEPS = {
    pair: None
    for row in ROWS
    for line in (row, row[::-1])
    for pair in zip(line, line[1:], strict=False)
}
DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d"
)

#: Letter pairs in five or more of 4,269 words of English documentation, by
#: first letter. Log10 of the words of a dictionary, letters of a long one, and what each
#: further letter costs.
FOLLOWERS = (
    "abcdefghiklmnprstuvwxyz babcdegijlmoprstuy cacehiklmoprstuy dabcdegilmnorsuvy "
    "eabcdefghiklmnopqrstuvwxyz fadefilorstuy gaceghilmnorstu haeilnortuy "
    "iabcdefgklmnoprstuvxz jacdeiopu kaeilnosuw lacdefgiklmoprstuvy mabdeimnopsu "
    "nabcdefghijklmnoprstuvyz oabcdefghijklmnoprstuvwxyz pacdehiloprstuy qu "
    "rabcdefghiklmnoprstuvy sacdefhiklmnoprstuy tabcdefhilmnoprstuwyz "
    "uabcdefgilmnoprstuxz vaeio waehilnors xaceipt yaceimnoprstw zaei"
).split()
PAIRS = {line[0] + c for line in FOLLOWERS for c in line[1:]}
DICTIONARY, LONG_WORD, FURTHER_LETTER = 5.0, 12, 0.5
WORD = re.compile(r"(?<![^\W\d_])(?:[A-Za-z][a-z]{3,}|[A-Z]{4,})(?![^\W\d_])")
#: What starts an address, what names a thing in code (letters before a bracket, or
#: joined by dots), the pieces of such a name, and the least letters of one on average.
ADDRESS = re.compile(r"[a-z][a-z0-9+.-]*://", re.IGNORECASE | re.ASCII)
NAME = re.compile(r"([A-Za-z_]+(?:\.[A-Za-z_]+)*)[(\[]|([A-Za-z_]+(?:\.[A-Za-z_]+)+)\Z")
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PIECE_LETTERS = 3
#: What lies between the parts of an address or of code.
PARTS = re.compile(r"[\s./:?&=#()\[\]{},;'\"_-]+")


def like_a_word(letters: str) -> bool:
    """Whether all neighbours among lower-case letters are pairs of words."""
    return all(a + b in PAIRS for a, b in zip(letters, letters[1:], strict=False))


def is_name(value: str) -> bool:
    """Whether a value starts with the name of something in code that is read or called."""
    found = NAME.match(value)
    if not found:
        return False
    pieces = [p.lower() for p in PIECE.findall(found.group(1) or found.group(2))]
    letters = sum(map(len, pieces))
    known = all(p in RANK or like_a_word(p) for p in pieces)
    return known and letters >= PIECE_LETTERS * max(1, len(pieces))


def runs(value: str) -> Iterator[tuple[int, int, float]]:
    """Spans that are easier than brute force, with the log10 of their guesses."""
    low = value.lower()
    for text, swapped in ((low, 0.0), (low.translate(SWAPS), math.log10(2))):
        for i in range(len(text)):
            for j in range(i + 3, min(len(text), i + LONGEST) + 1):
                rank = RANK.get(text[i:j])
                if rank:
                    part = value[i:j]
                    case = 0.0 if part == part.lower() else math.log10(2)
                    if case and part not in (part.upper(), part.capitalize()):
                        case = math.log10(2) * sum(c.isupper() for c in part)
                    yield i, j, math.log10(rank + 1) + case + swapped
    for m in WORD.finditer(value):  # words of prose, by their letter pairs
        word = m.group().lower()
        if like_a_word(word):
            case = 0.0 if m.group() == word else math.log10(2)
            yield *m.span(), DICTIONARY + FURTHER_LETTER * max(0, len(word) - LONG_WORD) + case
    for i in range(len(value)):
        found = DATE.match(value, i)
        if found:
            whole = found.end() - i > 4
            yield i, found.end(), math.log10(365 * 60 if whole else 60)
    start = 0
    for i in range(1, len(low) + 1):  # keyboard walks, and every prefix of one
        if i == len(low) or (low[i - 1], low[i]) not in STEPS:
            if i - start >= 3:
                yield start, i, math.log10(40 * (i - start))
            start = i
    for size in (1, 2, 3, 4):  # repeats of a short block
        start = 0
        for i in range(size, len(value) + 1):
            if i == len(value) or value[i] != value[i - size]:
                if i - start >= max(3, 2 * size):
                    yield start, i, math.log10(30**size * (i - start))
                start = i - size + 1


def guesses(value: str) -> float:
    """Log10 of the guesses that the cheapest segmentation of a value takes.

    A segment costs its guesses, and a factor for the ways to arrange one more. A
    brute-force span costs a factor of 10 a character. Linear in the length.
    """
    ending: dict[int, list[tuple[int, float]]] = {}
    for i, j, cost in runs(value):
        ending.setdefault(j, []).append((i, cost))
    arrange = math.log10(2)
    brute = [0.0] * (len(value) + 1)  # cheapest, the last segment brute force
    best = [0.0] * (len(value) + 1)
    for j in range(1, len(value) + 1):
        open_ = brute[j - 1] if j > 1 else 0.0
        brute[j] = 1.0 + min(open_, best[j - 1] + (arrange if j > 1 else 0.0))
        best[j] = min([brute[j], *(best[i] + c + arrange * (i > 0) for i, c in ending.get(j, ()))])
    return best[-1]


def hardness(value: str, quoted: bool) -> float:
    """Log10 of a value's guesses; for addresses and names in code, those of the hardest part."""
    if ADDRESS.match(value) or (not quoted and is_name(value)):
        return max(map(guesses, PARTS.split(value)))
    return guesses(value)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base spans, in their order."""
    spans = []
    if ASSIGN_HINTS.search(text):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_VALUE:
                spans.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                spans.append((m.start(), 1, m.end()))
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def hard_values(text: str, least: float) -> list[tuple[int, int]]:
    """Values in a credential context that take that many guesses."""
    found: dict[tuple[int, int], bool] = {}  # spans, and whether they are in quotes
    if ASSIGN_HINTS.search(text):
        for m in ASSIGN.finditer(text):
            start, end = m.span(2)
            if text[end : end + 1] not in ("(", "["):  # a call: the whole is judged below
                quoted = text[start - 1] in "\"'" and text[end : end + 1] == text[start - 1]
                found[start, end] = quoted
    if HINTS.search(text):
        for pattern in CONTEXTS:
            for m in pattern.finditer(text):
                start, end = m.span(m.lastindex)
                quoted = text[start - 1] in "\"'" and text[end : end + 1] == text[start - 1]
                while not quoted and end > start and text[end - 1] in "\"',;.)]}>":
                    end -= 1
                found.setdefault((start, end), quoted)
    return sorted(
        (s, e)
        for (s, e), quoted in found.items()
        if e - s >= LEAST_VALUE and hardness(text[s:e], quoted) >= least
    )


def scan_text(text: str, least: float = MIN_GUESSES) -> tuple[list, list]:
    """Base spans and added ones, each ``(start, kind name, end)``."""
    base = [(s, KINDS[k], e) for s, k, e in base_spans(text)]
    return base, [(s, GUESS, e) for s, e in hard_values(text, least)]


def joined(spans: list[tuple[int, str, int]]) -> str:
    order = {k: i for i, k in enumerate((*KINDS, GUESS))}
    spans = sorted(spans, key=lambda x: (x[0], order[x[1]], x[2]))
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list[tuple[int, str, int]], mark: str) -> str:
    """The text with every maximal run of overlapping spans replaced by the mark."""
    parts, at = [], 0
    last = -1
    for start, _, end in sorted(spans):
        if start >= last:
            parts += [text[at:start], mark]
        last = max(last, end)
        at = last
    return "".join(parts) + text[at:]


def scan(documents: DataFrame, least: float = MIN_GUESSES) -> DataFrame:
    """Spans of secrets, one row per document.

    Columns: ``doc_id``, the numbers of base spans by kind, ``base_sha256`` (of the
    base spans), ``spans`` (all, the added ones too). Spans are ``kind:start:end`` in
    code points, by start, then kind. A null or empty text has none. Documents are
    scanned one by one: repeated rows give repeated results, other columns are
    ignored, an empty table gives an empty result.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema["doc_id"].dataType),
            *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
            T.StructField("base_sha256", T.StringType()),
            T.StructField("spans", T.StringType()),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [[] for _ in KINDS], [], []
            for text in batch.column("text").to_pylist():
                base, added = scan_text(text or "", least)
                for found, kind in zip(counts, KINDS, strict=True):
                    found.append(sum(k == kind for _, k, _ in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(base + added))
            columns = [
                batch.column("doc_id"),
                *[pa.array(c, pa.int64()) for c in counts],
                pa.array(digests, pa.string()),
                pa.array(spans, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return documents.select("doc_id", "text").mapInArrow(rows, schema)


def redact(documents: DataFrame, least: float = MIN_GUESSES, mark: str = "[secret]") -> DataFrame:
    """The documents with each secret in ``text`` replaced by a mark.

    All columns stay; ``n_chars``, if there is one, is that of the new text where the
    text was changed. A null text stays null.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lengths = batch.column("text").to_pylist(), {}
            for i, text in enumerate(texts):
                base, added = scan_text(text or "", least)
                if base or added:
                    texts[i] = redacted(text, base + added, mark)
                    lengths[i] = len(texts[i])
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["text"] = pa.array(texts, batch.schema.field("text").type)
            if "n_chars" in columns:
                old = columns["n_chars"]
                new = [lengths.get(i, n) for i, n in enumerate(old.to_pylist())]
                columns["n_chars"] = pa.array(new, old.type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return documents.mapInArrow(rows, documents.schema)
