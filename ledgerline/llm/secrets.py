"""Secret scan with a worklist of decoded layers.

A text is the first layer. Each layer is scanned; its URL escapes, Unicode escapes, base64 runs and
compressed bytes are unwrapped into further layers, until no new layer comes up. A layer that was
seen before, by digest of its characters and the places they come from, is not entered again, so
cycles end; the same payload at another place is another layer. Every character of a layer knows
the span of the text that it comes from, so findings are reported in places of the text, in code
points. What is found in the text itself stays as it is; a layer adds spans.

All members and frames of compressed bytes are unpacked, and what stands behind them is looked at
too. A layer beyond ``limit`` bytes, or one whose dictionary is beyond ``MAX_DICTIONARY``, is not
unpacked further; it is reported as a span of kind ``oversize``. A stream that breaks off or is
damaged is unpacked up to there and reported as ``broken``. So none is passed over in silence.

Escapes are unwrapped step by step, each step a layer, ``STEPS`` times in a row; what is nested deeper
(``%252525...41``) is then unwrapped to its end in one layer, in time that grows with the text and
not with its square. No escape is left; only the layers between are not scanned by themselves.

Null and empty texts have no spans. Repeated rows and null ids each give a row; an empty table
gives an empty result. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import urllib.parse
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .batches import bounded
from .words import column, whole

STEPS = 8
MAX_LAYER = 64 << 20
MAX_DICTIONARY = 128 << 20
KINDS = ("assign", "access", "hex", "oversize", "broken")
MARK = "[SECRET]"

# ``re.ASCII`` with ``re.IGNORECASE`` matches letters of ASCII only.
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

URL_ESCAPE = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
    r"|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Runs over several lines, also as written in JSON; a line may be indented or quoted.
BREAK = r"(?:[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t>]*)"
RUN = "[A-Za-z0-9+/_-]"  # possessive, from its first character: linear in long runs
WRAPPED = re.compile(rf"(?<!{RUN}){RUN}{{16,}}+(?:{BREAK}{RUN}++)+={{0,2}}")
BREAKS = re.compile(BREAK)
# An escape at the end of what is decoded so far; only such characters end one.
LAST_ESCAPE = re.compile(rf"%([0-9A-Fa-f]{{2}})\Z|(?:{UNICODE_ESCAPE.pattern})\Z")
LAST = frozenset("0123456789abcdefABCDEF};")
LONGEST_ESCAPE = 11
ONE_BYTE = re.compile("%[0-9A-Fa-f]{2}|.", re.DOTALL)
# From twelve characters before the first escape: magic bytes may be written as they are.
URL_BYTES = re.compile(r"[!-$&-~]{0,12}%[0-9A-Fa-f]{2}(?:%[0-9A-Fa-f]{2}|[!-$&-~])*")
MAGIC = (b"\x1f\x8b", b"x\x01", b"x\x5e", b"x\x9c", b"x\xda", b"BZh", b"\xfd7zXZ\x00", b"\x28\xb5\x2f\xfd")
SKIPPED = re.compile(rb"[\x50-\x5f]\x2a\x4d\x18", re.DOTALL)  # a frame of zstd without content
STRONG = rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd"
STRONG_MAGIC = re.compile(STRONG + rb"|\Ax[\x01\x5e\x9c\xda]")  # two bytes count at the start only
ANY_MAGIC = re.compile(STRONG + rb"|x[\x01\x5e\x9c\xda]")
# No finding and no encoded one is shorter.
STRETCH = re.compile("[^\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f\ud800-\udfff]{16,}")


PLACE = np.int32  # a text has less than 2 ** 31 characters


def _digest(raw: bytes, *places: np.ndarray | None) -> bytes:
    state = hashlib.sha256(raw)
    for x in places:
        if x is not None and len(x):  # one value for all, without its copies
            state.update(np.ascontiguousarray(x[:1] if x.strides == (0,) else x, PLACE))
    return state.digest()


@dataclass
class Layer:
    """Text with the span of the first text behind each character (None: its own places), and how
    many steps of unescaping in a row it comes from."""

    text: str
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None
    steps: int = 0

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def digest(self) -> bytes:
        """Tells layers apart by text and places."""
        return _digest(self.text.encode("utf-8", "surrogatepass"), self.starts, self.ends)


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    lower = text.lower()
    if any(w in lower for w in WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 12:
                yield "assign", *m.span()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield "access", *m.span()
    for m in HEX.finditer(text):
        yield "hex", *m.span()


def _replaced(layer: Layer, found: list[tuple[int, int, str]]) -> Layer:
    """The layer with spans replaced; each new character comes from its whole span."""
    parts, starts, ends, at = [], [], [], 0
    n = len(layer.text)
    own = np.arange(n, dtype=PLACE) if layer.starts is None else layer.starts
    own_ends = np.arange(1, n + 1, dtype=PLACE) if layer.ends is None else layer.ends
    for start, end, new in found:
        first, last = layer.span(start, end)
        parts += [layer.text[at:start], new]
        starts += [own[at:start], np.full(len(new), first, PLACE)]
        ends += [own_ends[at:start], np.full(len(new), last, PLACE)]
        at = end
    parts.append(layer.text[at:])
    places = np.concatenate([*starts, own[at:]]), np.concatenate([*ends, own_ends[at:]])
    return Layer("".join(parts), *places, layer.steps + 1)


def _character(m: re.Match, group: int = 1) -> str | None:
    *hexes, decimal = m.groups()[group - 1 :]
    code = int(decimal) if decimal else int(next(x for x in hexes if x), 16)
    return None if code > 0x10FFFF or 0xD800 <= code < 0xE000 else chr(code)


def _unwrapped(layer: Layer) -> Layer | None:
    """The layer with nested escapes of ASCII characters unwrapped to their end; None if it has none.

    No two escapes overlap, so each is replaced as soon as its last character is there, and what
    comes out may end the next. Others than ASCII are part of no escape and are left to a step.
    """
    begin = min((i for i in map(layer.text.find, "%\\&") if i >= 0), default=len(layer.text))
    chars, firsts, lasts = list(layer.text[:begin]), list(range(begin)), list(range(1, begin + 1))
    for i, c in enumerate(layer.text[begin:], begin):
        chars.append(c)
        firsts.append(i)
        lasts.append(i + 1)
        while chars[-1] in LAST and (m := LAST_ESCAPE.search("".join(chars[-LONGEST_ESCAPE:]))):
            new = chr(int(m[1], 16)) if m[1] else _character(m, 2)
            if new is None or new > "\x7f":
                break
            size = len(m[0])
            first = firsts[-size]
            del chars[-size:], firsts[-size:], lasts[-size:]
            chars.append(new)
            firsts.append(first)
            lasts.append(i + 1)
    if len(chars) == len(layer.text):
        return None
    first, last = np.array(firsts, PLACE), np.array(lasts, PLACE)
    if layer.starts is not None:  # places never fall along a layer
        first, last = layer.starts[first], layer.ends[last - 1]
    return Layer("".join(chars), first, last, layer.steps)


def _unescaped(layer: Layer) -> Iterator[Layer]:
    if layer.steps >= STEPS and (inner := _unwrapped(layer)):
        yield inner
        return
    if "%" in layer.text:
        found = []
        for m in URL_ESCAPE.finditer(layer.text):
            raw = urllib.parse.unquote_to_bytes(m[0])
            new = raw.decode("utf-8", "replace")
            if len(new) == len(raw):  # ASCII: keep each escape apart
                found += [(m.start() + 3 * i, m.start() + 3 * i + 3, c) for i, c in enumerate(new)]
            else:
                found.append((*m.span(), new))
        if found:
            yield _replaced(layer, found)
    if "\\" in layer.text or "&#" in layer.text:
        found = [
            (*m.span(), c)
            for m in UNICODE_ESCAPE.finditer(layer.text)
            if (c := _character(m)) is not None
        ]
        if found:
            yield _replaced(layer, found)


class Oversize(Exception):
    pass


class _Zstd:
    """A frame of zstd by the interface of the other decompressors; output a call is bounded by
    the size of the pieces that it is fed."""

    def __init__(self):
        self.packer = zstandard.ZstdDecompressor(max_window_size=MAX_DICTIONARY).decompressobj()

    def __getattr__(self, name):
        return getattr(self.packer, name)

    def decompress(self, raw: bytes, _most: int) -> bytes:
        return self.packer.decompress(raw)


def _packer(raw: bytes):
    if raw.startswith(b"\x1f\x8b"):
        return zlib.decompressobj(31)
    if raw.startswith(b"BZh"):
        return bz2.BZ2Decompressor()
    if raw.startswith(b"\xfd7zXZ\x00"):
        return lzma.LZMADecompressor(memlimit=MAX_DICTIONARY)
    if raw.startswith(b"\x28\xb5\x2f\xfd"):
        return _Zstd()
    return zlib.decompressobj() if raw.startswith(MAGIC) else None


ERRORS = (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError)
FEED = 512


def _member(raw: bytes, limit: int, slow: int | None = None) -> tuple[bytes, int, str]:
    """Unpacked bytes of the first member, its length, and "ended", "cut" or "damaged". From
    ``slow`` on it is fed by single bytes, for what stands just before the damage."""
    packer, parts, total, at = _packer(raw), [], 0, 0
    while at < len(raw):
        piece = raw[at : at + (FEED if slow is None or at < slow else 1)]
        try:
            out = packer.decompress(piece, limit + 1 - total)
        except ERRORS as e:
            if "emory" in str(e):  # "Memory usage limit exceeded", "requires too much memory"
                raise Oversize from e
            return _member(raw, limit, at) if slow is None else (b"".join(parts), at, "damaged")
        parts.append(out)
        total += len(out)
        if total > limit:
            raise Oversize
        at += len(piece)
        if packer.eof:
            return b"".join(parts), at - len(packer.unused_data), "ended"
    return b"".join(parts), len(raw), "cut"


def _inflated(raw: bytes, limit: int) -> tuple[bytes, int, bool] | None:
    """Unpacked bytes of all members, how many bytes they take, and whether the last came to its
    end; None if these are no compressed bytes."""
    parts, total, at = [], 0, 0
    while raw.startswith(MAGIC, at) or SKIPPED.match(raw, at):
        if SKIPPED.match(raw, at):
            at += 8 + int.from_bytes(raw[at + 4 : at + 8], "little")
            continue
        out, size, end = _member(raw[at:], limit - total)
        weak = raw.startswith(b"x", at)  # two bytes that may well be others
        if end != "ended" and (not STRETCH.search(_lossy(out)) if weak else not out and end != "cut"):
            break
        parts.append(out)
        total += len(out)
        at += size
        if end != "ended":
            return b"".join(parts), len(raw), False
    return (b"".join(parts), min(at, len(raw)), True) if parts else None


def _lossy(raw: bytes) -> str:
    return raw.decode("utf-8", "surrogateescape")


@dataclass
class Blob:
    """Bytes with the span of the first text behind each."""

    raw: bytes
    starts: np.ndarray
    ends: np.ndarray

    def texts(self) -> Iterator[Layer]:
        """Stretches of printable UTF-8, long enough for a finding or a further layer."""
        text, at, offset = _lossy(self.raw), 0, 0
        for m in STRETCH.finditer(text):
            offset += len(text[at : m.start()].encode("utf-8", "surrogateescape"))
            own = np.frombuffer(m[0].encode(), np.uint8)
            first = offset + np.flatnonzero(own & 0xC0 != 0x80)
            offset, at = offset + len(own), m.end()
            if self.starts.strides == (0,):
                yield Layer(m[0], np.broadcast_to(self.starts[0], len(first)), np.broadcast_to(self.ends[0], len(first)))
            else:
                yield Layer(m[0], self.starts[first], self.ends[np.append(first[1:], offset) - 1])


def _dug(blob: Blob, limit: int) -> Iterator[Layer | tuple[str, int, int]]:
    """Texts in the bytes and in what is compressed there; bare spans: streams by how they end."""
    work, seen, magic = [blob], set(), ANY_MAGIC
    while work:
        blob = work.pop()
        if (digest := _digest(blob.raw, blob.starts, blob.ends)) in seen:
            continue
        seen.add(digest)
        yield from blob.texts()
        at = 0
        while m := magic.search(blob.raw, at):
            at = m.start()
            try:
                found = _inflated(blob.raw[at:], limit)
            except Oversize:
                yield "oversize", int(blob.starts[at:].min()), int(blob.ends[at:].max())
                break
            if found is None:
                at += 1
                continue
            out, size, ended = found
            first, last = int(blob.starts[at : at + size].min()), int(blob.ends[at : at + size].max())
            yield "ended" if ended else "broken", first, last
            if out:
                work.append(Blob(out, *(np.broadcast_to(PLACE(x), len(out)) for x in (first, last))))
            at += size
        magic = STRONG_MAGIC


def _from_base64(layer: Layer, at: np.ndarray, end: int) -> Blob | None:
    """The bytes of the base64 characters at these places of a layer, padding up to ``end``; None
    if there is nothing to be found in them."""
    at = at[: len(at) - (len(at) % 4 == 1)]
    run = "".join([layer.text[i] for i in at.tolist()]).replace("-", "+").replace("_", "/")
    raw = base64.b64decode(run + "=" * (-len(run) % 4))
    if not ANY_MAGIC.search(raw) and not STRETCH.search(_lossy(raw)):
        return None
    group = np.arange(len(raw)) // 3 * 4  # three bytes for four characters
    first, last = at[group], at[np.minimum(group + 3, len(at) - 1)]
    last[group + 4 >= len(at)] = end - 1
    return Blob(raw, *((first, last + 1) if layer.starts is None else (layer.starts[first], layer.ends[last])))


def _blobs(layer: Layer) -> Iterator[Blob]:
    """Bytes of base64 runs, line by line and joined over lines, from each of the four places
    where a group of four may begin, as path or name characters may stand before; and compressed
    bytes below URL escapes."""
    runs = [(np.arange(m.start(), m.start() + len(m[0].rstrip("="))), m.end()) for m in BASE64.finditer(layer.text)]
    for m in WRAPPED.finditer(layer.text) if runs else ():
        body = m[0].rstrip("=")
        here = np.ones(len(body), bool)
        for gap in BREAKS.finditer(body):
            here[gap.start() : gap.end()] = False
        runs.append((m.start() + np.flatnonzero(here), m.end()))
    for at, end in runs:
        for skip in range(4):
            blob = _from_base64(layer, at[skip:], end)
            if blob:
                yield blob
    for m in URL_BYTES.finditer(layer.text) if "%" in layer.text else ():
        raw = urllib.parse.unquote_to_bytes(m[0])
        if not ANY_MAGIC.search(raw):
            continue
        last = np.array([e.end() for e in ONE_BYTE.finditer(m[0])]) + m.start()
        first = np.concatenate(([m.start()], last[:-1]))
        yield Blob(raw, *((first, last) if layer.starts is None else (layer.starts[first], layer.ends[last - 1])))


def _unpacked(layer: Layer, limit: int) -> Iterator[Layer | tuple[str, int, int]]:
    """Layers of bytes that stand encoded in the layer; a bare span: not unpacked further."""
    ended, broken = set(), []
    for blob in _blobs(layer):
        for x in _dug(blob, limit):
            if isinstance(x, Layer) or x[0] == "oversize":
                yield x
            elif x[0] == "ended":
                ended.add(x[1])
            else:
                broken.append(x)
    yield from (x for x in broken if x[1] not in ended)


def scan(text: str, limit: int = MAX_LAYER) -> tuple[list, list]:
    """Spans ``(kind, start, end)`` of the text itself, and of all layers, each in order."""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base = sorted(base_spans(text), key=order)
    found, work = set(base), [Layer(text)]
    seen = {work[0].digest()}
    while work:
        layer = work.pop()
        for inner in (*_unescaped(layer), *_unpacked(layer, limit)):
            if not isinstance(inner, Layer):
                found.add(inner)
                continue
            digest = inner.digest()
            if digest in seen:
                continue
            seen.add(digest)
            found |= {(kind, *inner.span(a, b)) for kind, a, b in base_spans(inner.text)}
            work.append(inner)
    return base, sorted(found, key=order)


def redact(text: str, spans) -> str:
    """The text with every span, overlapping ones as one, replaced by ``MARK``."""
    parts, at, end = [], 0, -1
    for _, start, stop in sorted(spans, key=lambda s: s[1:]):
        if start > end:
            if end >= 0:
                at = end
            parts += [text[at:start], MARK]
        end = max(end, stop)
    return "".join(parts) + text[max(end, 0) :] if parts else text


def _listed(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


FOUND = StructType(
    [StructField(c, LongType()) for c in ("n_assign", "n_access", "n_hex")]
    + [StructField(c, StringType()) for c in ("base", "spans")]
)


def _scanned(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        base, found = scan(text)
        kinds = [kind for kind, *_ in base]
        rows.append((*(kinds.count(k) for k in KINDS[:3]), _listed(base), _listed(found)))
    return pd.DataFrame(rows, columns=FOUND.names)


def _redacted(texts: pd.Series) -> pd.Series:
    return pd.Series([redact(t, scan(t)[1]) for t in texts], dtype=object)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and spans of every text; one pass, no shuffle."""
    bounded(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.pandas_udf(_scanned, FOUND)(whole(text)).alias("found"))
    return rows.select("doc_id", "found.*")


def redacted(docs: DataFrame, text: str = "text", n_chars: str | None = None) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``MARK``; other columns as they are, but
    ``n_chars``, if given, is counted anew. A null text stays null."""
    bounded(docs.sparkSession)
    new = F.when(F.col(text).isNotNull(), F.pandas_udf(_redacted, StringType())(whole(text)))
    kind = docs.schema[text].dataType
    rows = docs.select(*(new.cast(kind).alias(c) if c == text else column(c) for c in docs.columns))
    if n_chars is None:
        return rows
    length = F.char_length(F.col(text)).cast(docs.schema[n_chars].dataType)
    counted = F.when(F.col(text).isNull(), F.col(n_chars)).otherwise(length)
    return rows.select(*(counted.alias(c) if c == n_chars else column(c) for c in rows.columns))


def op1_secrets(spark, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans"
    )

