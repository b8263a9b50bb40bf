"""Secret scans with structural confirmation.

Three base kinds come from their patterns alone. Further candidates (runs of
base64 or hex letters, dotted tokens, armoured blocks) are reported only when
their decoded form confirms them:

* ``jwt``: a dotted token whose first part decodes to a JSON object with an
  ``alg`` and whose second part decodes to JSON (or, for encrypted tokens, that
  has five parts and an ``enc``);
* ``pem``: an armoured private key whose body decodes to a key encoding;
* ``der``: a base64 or hex run that decodes to a private key: nested DER
  lengths that fill their parents exactly and the fields of RSA, EC or PKCS#8
  keys, or the length-prefixed fields of an OpenSSH key;
* ``encoded``: a base64 or hex run whose bytes are printable text in which a
  base kind is found.

A dotted token is tried whole, then as its first five and first three parts
(a full stop or a file name may follow it). Runs on following lines, as wrapped
base64 has them, are also tried joined.

Defined cases: a null or empty text has no spans; spans of different kinds may
overlap; repeated rows get equal results; other columns pass through (one
called ``spans`` is replaced); an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from marketlens.llm import spans
from marketlens.llm.spans import Span

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "jwt", "pem", "der", "encoded")

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # shorter runs fail as a whole, so asking for 18 finds the same
_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
#: Tried once a run of letters, from its first "eyJ": where that has no two further parts, a later one has none either.
_DOTTED = re.compile(r"(?<![A-Za-z0-9_-])(?:(?!eyJ)[A-Za-z0-9_-])*+(eyJ[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+){2,4}+)")
_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]++={0,2})+")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_ARMOUR = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----")
_TEXT = re.compile(rb"[\x09\x0A\x0D\x20-\x7E]+")


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that are long enough."""
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def _length(data: bytes, at: int) -> tuple[int, int] | None:
    """A DER length at ``at`` and where the value begins."""
    if at >= len(data):
        return None
    first = data[at]
    if first < 0x80:
        return first, at + 1
    n = first & 0x7F
    if not 1 <= n <= 4 or at + 1 + n > len(data):
        return None
    return int.from_bytes(data[at + 1:at + 1 + n]), at + 1 + n


def der_fields(data: bytes, low: int = 0, high: int | None = None) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the values that fill the range exactly, else None."""
    high = len(data) if high is None else high
    out, at = [], low
    while at < high:
        size = _length(data[:high], at + 1)
        if size is None or size[1] + size[0] > high:
            return None
        out.append((data[at], size[1], size[1] + size[0]))
        at = size[1] + size[0]
    return out


def _nested(data: bytes) -> bool:
    """Every constructed value's parts fill it exactly."""
    todo = [(0, len(data))]
    while todo:
        parts = der_fields(data, *todo.pop())
        if parts is None:
            return False
        todo += [(a, b) for tag, a, b in parts if tag & 0x20]
    return True


def key_kind(data: bytes) -> str | None:
    """What private key encoding the bytes are, if any."""
    if data.startswith(b"openssh-key-v1\0"):
        at = 15
        for _ in range(3):  # cipher, key derivation and its options
            if at + 4 > len(data):
                return None
            at += 4 + int.from_bytes(data[at:at + 4])
        return "openssh" if at + 4 <= len(data) else None
    if not data.startswith(b"\x30") or len(data) < 32:
        return None
    outer = der_fields(data)
    if outer is None or len(outer) != 1 or not _nested(data):
        return None
    inner = der_fields(data, *outer[0][1:])
    tags = [t for t, _, _ in inner]
    if not tags or tags[0] != 0x02 or inner[0][2] - inner[0][1] != 1:
        return None  # a key begins with its version
    if len(tags) >= 9 and set(tags[:9]) == {0x02}:
        return "rsa"
    if len(tags) >= 2 and tags[1] == 0x04:
        return "ec"
    if len(tags) >= 6 and set(tags[:6]) == {0x02}:
        return "dsa"
    if len(tags) >= 3 and tags[1] == 0x30 and tags[2] == 0x04:
        algorithm = der_fields(data, *inner[1][1:])
        return "pkcs8" if algorithm and algorithm[0][0] == 0x06 else None
    return None


def _base64(run: str) -> bytes | None:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json(part: str) -> object:
    data = _base64(part)
    try:
        return None if data is None else json.loads(data)
    except (ValueError, RecursionError):
        return None


def is_signed_token(token: str) -> bool:
    parts = token.split(".")
    header = _json(parts[0])
    if not isinstance(header, dict) or not isinstance(header.get("alg"), str):
        return False
    if len(parts) == 5:
        return isinstance(header.get("enc"), str)
    return len(parts) == 3 and isinstance(_json(parts[1]), dict)


def _signed_tokens(text: str) -> Iterator[Span]:
    m = _DOTTED.search(text)
    while m:
        parts = m[1].split(".")
        heads = [m[1], *(".".join(parts[:n]) for n in (5, 3) if n < len(parts) and parts[n - 1])]
        token = next((t for t in heads if is_signed_token(t)), None)
        if token:
            yield "jwt", m.start(1), m.start(1) + len(token)
        # a rejected token's later parts may begin one
        m = _DOTTED.search(text, m.start(1) + len(token or parts[0]))


def _decoded_kind(run: str) -> str | None:
    """What a base64 or hex run is confirmed as."""
    decoded = [_base64(run)]
    if len(run) % 2 == 0:
        try:
            decoded.append(bytes.fromhex(run))
        except ValueError:
            pass
    for data in decoded:
        if not data:
            continue
        if key_kind(data):
            return "der"
        if len(data) >= 16 and _TEXT.fullmatch(data) and base_spans(data.decode("ascii")):
            return "encoded"
    return None


def _wrapped(text: str) -> Iterator[Span]:
    """Confirmed runs over several lines: all of one width but the first and the last, which may be shorter."""
    for block in _LINES.finditer(text):
        lines = list(_LINE.finditer(text, *block.span()))
        size = [len(line[0]) for line in lines]
        first = 0
        while first + 1 < len(lines):
            width, stop = max(size[first:first + 2]), first + 1
            while stop < len(lines) and size[stop] == width and not lines[stop - 1][0].endswith("="):
                stop += 1
            # the shorter line after the full ones may be the run's last, or text
            ends = [stop + 1] if stop < len(lines) and size[stop] < width and not lines[stop - 1][0].endswith("=") else []
            for end in [*ends, *([stop] if stop > first + 1 else [])]:
                kind = _decoded_kind("".join(line[0] for line in lines[first:end]))
                if kind:
                    yield kind, lines[first].start(), lines[end - 1].end()
                    first = end
                    break
            else:
                # a shorter first line may be text; lines of one width are tried once
                first = stop if size[first] == width else first + 1


def find(text: str) -> list[Span]:
    """All spans of a text, in order."""
    out = set(base_spans(text))
    if "eyJ" in text:
        out.update(_signed_tokens(text))
    armoured = []
    if "-----BEGIN " in text:
        for m in _ARMOUR.finditer(text):
            data = _base64("".join(m[2].split()))
            if data is not None and (key_kind(data) or m[1].startswith("ENCRYPTED") and _nested(data)):
                armoured.append(("pem", *m.span()))
    out.update(armoured)
    for m in _RUN.finditer(text):
        kind = _decoded_kind(m[0])
        if kind:
            out.add((kind, *m.span()))
    if "\n" in text:
        out.update(s for s in _wrapped(text) if not any(a <= s[1] and s[2] <= b for _, a, b in armoured))
    return spans.ordered(out, KINDS)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``spans`` of their whole text."""
    return spans.annotate(docs, lambda: find, text)
