"""What holds for any chunking of a text, and fixes it, stated without chunking anything."""

from __future__ import annotations


def heading(line: str) -> str | None:
    line = line.strip()
    return (line.lstrip("#").strip() or "root") if line.startswith("#") else None


def check_chunks(text: str, chunks: list[tuple], target: int = 900, overlap: int = 120) -> None:
    """``chunks``: (text, section, start line, end line) in order, none dropped for its length.

    Only for texts whose lines all hold something, so that no span is blank."""
    lines = text.splitlines()
    size = lambda a, b: sum(len(x) + 1 for x in lines[a - 1:b])
    headings = {i: h for i, x in enumerate(lines, 1) if (h := heading(x)) is not None}
    if not lines:
        assert chunks == []
        return
    assert chunks[0][2] == 1 and chunks[-1][3] == len(lines)
    for before, (body, section, first, last) in zip([0, *(c[3] for c in chunks)], chunks):
        assert body == "\n".join(lines[first - 1:last]).strip()
        assert section == next((headings[i] for i in range(last, 0, -1) if i in headings), "root")
        # Each line after those that come again: the span was not full before it, and if it is a
        # heading not even three fifths full.
        assert all(size(first, i - 1) < target for i in range(before + 2, last + 1))
        assert all(size(first, i - 1) < int(target * 0.6) for i in headings if before < i <= last and first < i)
    for (_, _, first, last), (_, _, start, _) in zip(chunks, chunks[1:]):
        if size(first, last) >= target:  # filled: the fewest last lines that reach the overlap come again
            assert start <= last and (size(start, last) >= overlap or start == 1) and size(start + 1, last) < overlap
        else:  # closed by a heading: nothing comes again
            assert start == last + 1 and start in headings and size(first, last) >= int(target * 0.6)
