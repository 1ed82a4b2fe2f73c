"""A small shell over a catalog: list, show schema <name>, help, exit."""

from __future__ import annotations

import sys

from .catalog import Catalog, parse_files, parse_sources, parse_tables
from .errors import EngineError

HELP = "list | show schema <name> | help | exit"


def answer(catalog: Catalog, line: str) -> str | None:
    """What the shell says to a line; None ends it."""
    words = line.strip().rstrip(";").split()
    if not words:
        return ""
    match [w.lower() for w in words[:2]]:
        case ["exit" | "quit", *_]:
            return None
        case ["list", *_]:
            return "\n".join(catalog.list())
        case ["show", "schema"] if len(words) == 3:
            try:
                return catalog.show(words[2])
            except EngineError as e:
                return str(e)
    return HELP


def main(paths: list[str]) -> None:
    """Paths end in .source, .file or .table."""
    readers, catalog = {"source": parse_sources, "file": parse_files, "table": parse_tables}, Catalog()
    for p in paths:
        with open(p, encoding="utf-8") as f:
            catalog.add(*readers[p.rsplit(".", 1)[-1]](f.read()))
    for line in sys.stdin:
        if (said := answer(catalog, line)) is None:
            break
        print(said)


if __name__ == "__main__":
    main(sys.argv[1:])
