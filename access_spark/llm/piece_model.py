"""Reading a SentencePiece model file: pieces, scores, types and the normaliser's map."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

# Field numbers of the model file, piece types, and the sign for a space.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE = "▁"


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of one protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at : at + size]
            at += size


@dataclass
class PieceModel:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    charmap: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True
    byte_fallback: bool = False
    unknown_surface: str = " ⁇ "
    ids: dict[str, int] = field(default_factory=dict)
    byte_ids: list[int] = field(default_factory=list)
    unknown_id: int = 0
    end_id: int = -1

    def __post_init__(self) -> None:
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, USER_DEFINED, UNUSED)}
        named = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.byte_ids = [named.get(f"<0x{b:02X}>", -1) for b in range(256)]
        self.unknown_id = self.kinds.index(UNKNOWN)
        self.end_id = next((i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == CONTROL and p == "</s>"), -1)


def parse(data: bytes) -> PieceModel:
    """A BPE or unigram model. Pieces split into several by user-defined symbols or with the
    space sign as a suffix are not supported."""
    pieces, scores, kinds, options = [], [], [], {}
    for number, value in fields(data):
        if number == 1:
            held = dict(fields(value))
            pieces.append(held[1].decode())
            scores.append(struct.unpack("<f", held[2])[0] if 2 in held else 0.0)
            kinds.append(held.get(3, NORMAL))
        elif number == 2:
            held = dict(fields(value))
            options |= {"byte_fallback": bool(held.get(35, 0))}
            if 44 in held:
                options["unknown_surface"] = held[44].decode()
            if held.get(24):
                raise ValueError("the space sign as a suffix is not supported")
        elif number == 3:
            held = dict(fields(value))
            options |= {"charmap": held.get(2, b""), "dummy_prefix": bool(held.get(3, 1)), "trim_spaces": bool(held.get(4, 1)), "escape_spaces": bool(held.get(5, 1))}
    if USER_DEFINED in kinds:
        raise ValueError("user-defined symbols are not supported")
    return PieceModel(pieces, scores, kinds, **options)


def compiled_map(charmap: bytes) -> tuple[list[int], bytes]:
    """(units of the double array, replacements ended by zero bytes) of a compiled map."""
    if not charmap:
        return [], b""
    size = struct.unpack("<I", charmap[:4])[0]
    return list(struct.unpack(f"<{size // 4}I", charmap[4 : 4 + size])), charmap[4 + size :]


class CharacterMap:
    """The compiled character map: bytes of a text to their replacement, longest prefix first.

    Each unit of the double array holds a label, whether a value follows and the offset of
    its children, which lie at offset XOR label.
    """

    def __init__(self, charmap: bytes) -> None:
        self.units, self.blob = compiled_map(charmap)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes consumed, replacement) of the longest entry that the text has at `at`."""
        units, found = self.units, None
        if not units:
            return None
        node = _offset(units[0])
        for k in range(at, len(text)):
            label = text[k]
            node ^= label
            if node >= len(units) or units[node] & 0x800000FF != label:
                break
            unit = units[node]
            node ^= _offset(unit)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                found = k + 1 - at, self.blob[start : self.blob.index(b"\0", start)]
        return found


def _offset(unit: int) -> int:
    return unit >> 10 << ((unit & 0x200) >> 6)


def normalise(text: str, model: PieceModel, charmap: CharacterMap | None = None) -> tuple[str, list[int] | None]:
    """(normalised text, byte of the original at which each of its characters begins, and the
    end of the original).

    The alignment is None where it is the identity after the prefix: then the normalised
    character i comes from the original character i, less the prefix.
    """
    charmap = charmap or CharacterMap(model.charmap)
    space = SPACE if model.escape_spaces else " "
    if not charmap.units and not model.trim_spaces:
        if not text:
            return "", None
        return (space if model.dummy_prefix else "") + (text.replace(" ", space) if model.escape_spaces else text), None
    data, at, parts = text.encode(), 0, []
    while at < len(data):
        used = charmap.longest(data, at)
        if used is None:
            lead = data[at]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            used = width, data[at : at + width]
        parts.append((used[1].decode(), at))
        at += used[0]
    if model.trim_spaces:
        while parts and not parts[0][0].strip(" "):
            parts.pop(0)
    if not parts:
        return "", [len(data)]
    out, origin = [], []
    before = model.trim_spaces
    if model.dummy_prefix:
        out.append(" ")
        origin.append(parts[0][1])
    for piece, start in parts:
        if model.trim_spaces and before:
            piece = piece.lstrip(" ")
        out.extend(piece)
        origin.extend([start] * len(piece))
        if piece:
            before = model.trim_spaces and piece.endswith(" ")
        # a replacement that is empty leaves the state of spaces as it was
    end = len(data)
    if model.trim_spaces:
        while out and out[-1] == " ":
            out.pop()
            end = origin.pop()
    return "".join(out).replace(" ", space), [*origin, end]
