"""Secret scan: fixed patterns, and strings that a primed compressor cannot shorten.

The fixed patterns give ``assign``, ``access`` and ``hex`` spans. The method adds ``novel`` spans:
a candidate is a run of 16 or more key characters with both letters and digits in sensitive context:
a sensitive word stands on its line, on the line with text before or after it, or within ``NEAR``
characters before it. Runs with no word between them (lines of a key, segments of a token) and all
runs between a BEGIN and its END share their context, however many they are. If a run between BEGIN
and END is reported, so are the others there, the short last one too. A candidate's novelty is what
it adds to a zstandard
frame: the size of (text around it + candidate) less the size of the text around it alone, with a
dictionary of identifiers and the surrounding text as the primer. Words, paths and identifiers the
primer knows add next to nothing; random strings add nearly their entropy. Candidates that add at
least ``NOVELTY`` bytes a character, and don't overlap a fixed span, are reported with that figure.

Defined cases: null text is empty; an empty text has no spans. Positions are code points, ends
exclusive. Texts are scanned whole; the primer of a candidate is the text within ``AROUND``
characters on both sides, whatever the text's length, less other copies of the candidate. Every
place of a string found novel is reported, with or without a sensitive word. Repeated rows are each
returned.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import map_rows, sha256_hex

#: Fixed patterns, by the query's contract.
KINDS = ("assign", "access", "hex")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile(
    "(?:" + "|".join([*map(_either_case, WORDS[:4]), _either_case("api") + "_?" + _either_case("key")]) + ")"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Context words of candidates: whole words, or the last part of an identifier in any style. The first
#: group also counts at the end of a word written together (``dbpassword``).
ANYWHERE = "password|passwd|passphrase|secret|token|credential|bearer|(?:api|access|private|public|secret|auth|signing|encryption)_?key"
WHOLE = "key|private|auth|authori[sz]ation|authentication|signature|session|cookie|connection|client_?id|pwd"
SENSITIVE = re.compile(
    rf"(?i:{ANYWHERE})(?i:s|id)?(?![a-z])|(?<![A-Za-z])(?i:{WHOLE})(?i:s|id)?(?![a-z])"
    + r"|(?<=[a-z])(?:Key|Private|Auth|Authori[sz]ation|Signature|Session|Cookie|Connection|ClientId|Pwd)s?(?![a-z])"
)
#: Every sensitive word holds one of these: a fast first test.
STEMS = ("passw", "passphrase", "secret", "token", "credential", "bearer", "key", "private", "auth", "signature",
    "session", "cookie", "connection", "client", "pwd",
)
#: Identifiers that code and its comments are full of; they prime the compressor.
IDENTIFIERS = (
    "import from return function class public private static const let var def self this null none true false "
    "string int float bool list dict array object value result index length count name type data file path line "
    "token password secret api_key access_key client_secret private_key public_key username user email host port "
    "config settings environment process.env os.environ getenv request response headers authorization bearer "
    "content-type application/json http https www.example.com localhost admin default test example sample "
    "changeme placeholder your_api_key_here xxxxxxxxxxxxxxxx 0123456789abcdef ABCDEFGHIJKLMNOPQRSTUVWXYZ "
    "abcdefghijklmnopqrstuvwxyz 00000000000000000000 sha256 sha1 md5 base64 utf-8 uuid version release"
)
#: A candidate's characters, its least length, the text around it, the novelty it needs.
LEAST = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
PART = re.compile(r"[A-Za-z0-9+_-]{16,}=*")
AROUND = 512
NEAR = 96
NOVELTY = 0.6


class Novelty:
    """Marginal compressed bytes of a string."""

    def __init__(self, identifiers: str = IDENTIFIERS):
        self.primer = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=9, dict_data=self.primer, write_content_size=False)

    def size(self, text: str) -> int:
        return len(self.compressor.compress(text.encode("utf-8", "surrogatepass")))

    def __call__(self, text: str, start: int, end: int) -> float:
        own = {text[a:b] for a, b in _parts(text, start, end)}
        around = _without(text, max(0, start - AROUND), start, own) + _without(text, end, end + AROUND, own)
        return (self.size(around + text[start:end]) - self.size(around)) / (end - start)


def _parts(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """The string and what it holds between = and / that is long enough to be a candidate by itself."""
    parts = [m.span() for m in PART.finditer(text, start, end) if _mixed(m.group())]
    return [(start, end), *(p for p in parts if p != (start, end))]


def _without(text: str, start: int, end: int, strings: set[str]) -> str:
    """``text[start:end]`` less all that belongs to one of the strings, also if the ends cut it."""
    end = min(end, len(text))
    cuts = []
    for own in strings:
        # Strings end where key characters end, so none reaches over to what the window adjoins.
        at = text.find(own, max(0, start - len(own) + 1), min(len(text), end + len(own) - 1))
        while at >= 0:
            cuts.append((at, at + len(own)))
            at = text.find(own, at + len(own), min(len(text), end + len(own) - 1))
    if not cuts:
        return text[start:end]
    out, last = [], start
    for a, b in sorted(cuts):
        if a > last:
            out.append(text[last : min(a, end)])
        last = max(last, b)
    return "".join([*out, text[last:end]])


def fixed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by start, then kind."""
    out = []
    low = text.lower() if text.isascii() else text.translate(_LOWER)
    if any(w in low for w in WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


#: What may stand between runs of one key or token: no word, but escapes of line ends.
GAP = re.compile(r"(?:\\[nrt]|[\W_])*")
LINE = re.compile(r"[^\r\n]+")
MARKER = re.compile(r"-{4,5} ?(BEGIN|END) ([A-Za-z0-9 ]+?) ?-{4,5}")
BODY = re.compile(r"[A-Za-z0-9+/=]+")


class _Context:
    """Where sensitive words stand in a text, by lines that are not blank."""

    def __init__(self, text: str):
        self.text = text
        self.lines = [m.span() for m in LINE.finditer(text) if not m.group().isspace()]
        self.starts = [a for a, _ in self.lines]
        self.seen: dict[int, bool] = {}

    def _line(self, k: int) -> bool:
        if not 0 <= k < len(self.lines):
            return False
        if k not in self.seen:
            a, b = self.lines[k]
            self.seen[k] = _sensitive(self.text[a:b])
        return self.seen[k]

    def __call__(self, at: int) -> bool:
        k = bisect_right(self.starts, at) - 1
        return self._line(k) or self._line(k - 1) or self._line(k + 1) or _sensitive(self.text[max(0, at - NEAR) : at])


def _sensitive(text: str) -> bool:
    low = text.lower()
    return any(w in low for w in STEMS) and SENSITIVE.search(text) is not None


def _blocks(text: str) -> list[tuple[int, int, int]]:
    """``(marker, start, end)`` of what stands between a BEGIN and the END of the same name."""
    out, begin = [], None
    for m in MARKER.finditer(text) if "BEGIN" in text else ():
        if m.group(1) == "BEGIN":
            begin = m
        elif begin is not None and begin.group(2) == m.group(2):
            out.append((begin.start(), begin.end(), m.start()))
            begin = None
    return out


def _in_context(text: str, runs: list[tuple[int, int]], blocks: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each run is in sensitive context, by itself or by the runs it belongs to."""
    context, out, held = _Context(text), [], []
    last, at, found = None, 0, False
    for a, b in runs:
        while at < len(blocks) and blocks[at][2] <= a:
            at += 1
        block = at if at < len(blocks) and blocks[at][1] < b else None
        joined = last is not None and (block is not None and block == last[1] or GAP.fullmatch(text, last[0], a))
        if not joined:
            out += [found] * len(held)
            held, found = [], False
        found = found or context(a) or block is not None and context(blocks[block][0])
        held.append(a)
        last = b, block
    return out + [found] * len(held)


class _Taken:
    """Spans already reported, merged, to ask what overlaps them."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for a, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def __call__(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end) - 1
        return k >= 0 and self.ends[k] > start


def _mixed(own: str) -> bool:
    return any(c.isdigit() for c in own) and any(c.isalpha() for c in own)


def novel_spans(text: str, fixed: list[tuple[str, int, int]], novelty: Novelty, least: float = NOVELTY):
    """``(start, end, novelty)`` of incompressible strings in sensitive context."""
    runs = [m.span() for m in CANDIDATE.finditer(text)]
    if not any(_mixed(text[a:b]) for a, b in runs):
        return []
    blocks = _blocks(text)
    taken = _Taken((a, b) for _, a, b in fixed)
    found = {}
    for (start, end), sensitive in zip(runs, _in_context(text, runs, blocks), strict=True):
        if not sensitive or taken(start, end) or not _mixed(text[start:end]):
            continue
        worth = novelty(text, start, end)
        if worth >= least:
            found[start, end] = worth
    if found and blocks:
        own = _Taken(found)
        for _, start, end in blocks:
            if own(start, end):
                for line in LINE.finditer(text, start, end):
                    if ":" not in line.group():
                        for m in BODY.finditer(text, *line.span()):
                            if not own(*m.span()) and not taken(*m.span()):
                                found[m.span()] = novelty(text, *m.span())
    # Other places of a string found, or of a part of it that is novel by itself, are reported too.
    known: dict[str, float] = {}
    for (start, end), worth in list(found.items()):
        for a, b in _parts(text, start, end) if end - start >= LEAST else ():
            own = worth if (a, b) == (start, end) else novelty(text, a, b)
            if own >= least:
                known[text[a:b]] = max(own, known.get(text[a:b], 0.0))
    found |= _again(text, [r for r in runs if r not in found], known, taken)
    return [(a, b, worth) for (a, b), worth in sorted(found.items())]


def _again(text: str, runs: list[tuple[int, int]], known: dict[str, float], taken: _Taken) -> dict[tuple[int, int], float]:
    """Where the known strings stand in the runs, the longest first; looked up by how they begin."""
    begin: dict[str, list[str]] = {}
    for own in sorted(known, key=len, reverse=True):
        begin.setdefault(own[:LEAST], []).append(own)
    out = {}
    for at, end in runs if begin else ():
        while at + LEAST <= end:
            here = (x for x in begin.get(text[at : at + LEAST], ()) if at + len(x) <= end and text.startswith(x, at))
            own = next((x for x in here if not taken(at, at + len(x))), None)
            if own:
                out[at, at + len(own)] = known[own]
            at += len(own) if own else 1
    return out


def _join(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan_step(rows: Iterator[tuple]) -> Iterator[tuple]:
    novelty = Novelty()
    for doc_id, text in rows:
        text = text or ""
        fixed = fixed_spans(text)
        novel = novel_spans(text, fixed, novelty)
        spans = [(k, a, b, None) for k, a, b in fixed] + [("novel", a, b, w) for a, b, w in novel]
        spans.sort(key=lambda s: (s[1], [*KINDS, "novel"].index(s[0])))
        yield doc_id, [{"kind": k, "start": a, "end": b, "novelty": w} for k, a, b, w in spans]


def scan(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, spans``: array of kind, start, end, novelty (null for fixed patterns)."""
    own = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    schema = "doc_id long, spans array<struct<kind:string,start:int,end:int,novelty:double>>"
    return map_rows(own, _scan_step, schema)


def _digest_step(rows: Iterator[tuple]) -> Iterator[tuple]:
    for doc_id, spans in _scan_step(rows):
        every = [(s["kind"], s["start"], s["end"]) for s in spans]
        base = [s for s in every if s[0] != "novel"]
        count = [sum(s[0] == k for s in base) for k in KINDS]
        yield doc_id, *count, sha256_hex(_join(base).encode()), _join(every)


def scan_digests(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    own = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_rows(own, _digest_step, schema)


def redacted(text: str | None, novelty: Novelty, mark: str = "[secret]") -> str | None:
    """The text with every span, or joined run of spans, replaced by the mark."""
    if not text:
        return text
    fixed = fixed_spans(text)
    spans = sorted([(a, b) for _, a, b in fixed] + [(a, b) for a, b, _ in novel_spans(text, fixed, novelty)])
    out, at = [], 0
    for a, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame, text_col="text") -> DataFrame:
    """The same rows with secrets replaced; ``n_chars``, if there, follows. Other columns stay."""
    names = docs.columns
    place = names.index(text_col)
    count = names.index("n_chars") if "n_chars" in names else None
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        novelty = Novelty()
        for row in rows:
            text = redacted(row[place], novelty)
            if text != row[place]:
                own = list(row)
                own[place] = text
                if count is not None:
                    own[count] = len(text)
                row = tuple(own)
            yield row

    return map_rows(docs, step, schema)
