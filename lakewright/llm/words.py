"""Byte-level tokenizing of whole texts by parts that a worker remembers."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from lakewright.llm.rows import Memo

REMEMBERED = 400_000  # parts in each of the memo's two generations
REMEMBERED_CHARS = 64  # longer parts are not remembered


def is_open(part) -> bool:
    """Whether white space ends a part, so that it goes on beyond the next blank."""
    last = (part[0] if isinstance(part, tuple) else part)[-1:]
    return not last or last.isspace()


def joined(parts: list) -> list:
    """Parts between blanks, each open one joined with what follows it."""
    whole, pending = [], None
    for part in parts:
        if pending is None:
            pending = part
        elif isinstance(pending, tuple):
            pending = (f"{pending[0]} {part}",)
        else:
            pending = f"{pending} {part}"
        if not is_open(part):
            whole.append(pending)
            pending = None
    return whole if pending is None else [*whole, pending]


def part_text(part) -> str:
    """The characters that a part stands for."""
    return part[0] if isinstance(part, tuple) else f" {part}"


class PartEncoder:
    """Token ids of texts as packed little-endian 32-bit numbers.

    A text is cut before each blank that follows a character other than white space. There a byte-level
    tokenizer's pattern always begins a new match, and no match looks back, or ahead beyond white space, so that
    it handles each part by itself. Parts are named without that blank; the first, which has none, as a tuple.
    ``encode`` turns texts into packed ids; it is asked once for a part as long as the memo holds it.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], remembered: int = REMEMBERED) -> None:
        self.encode, self.memo = encode, Memo(remembered)

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        parts, known = text.split(" "), self.memo.young
        parts[0] = (parts[0],)
        hits = [known.get(part) for part in parts]
        missing = [at for at, hit in enumerate(hits) if hit is None]
        if any(is_open(parts[at]) for at in missing):  # such parts are not remembered
            parts = joined(parts)
            hits = [known.get(part) for part in parts]
            missing = [at for at, hit in enumerate(hits) if hit is None]
        if missing:
            found = {parts[at]: None for at in missing}
            unknown = []
            for part in found:
                found[part] = self.memo.recall(part)
                if found[part] is None:
                    unknown.append(part)
            for part, ids in zip(unknown, self.encode([part_text(p) for p in unknown])):
                found[part] = ids
                if len(part) <= REMEMBERED_CHARS and not is_open(part):
                    self.memo.put(part, ids)
            for at in missing:
                hits[at] = found[parts[at]]
        return b"".join(hits)
