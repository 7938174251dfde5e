"""JSON as the record format reads it: no byte order mark, no repeated keys, nothing trailing."""

from __future__ import annotations

import json
from collections import Counter, deque
from typing import Any


class Record(dict):
    """An object that remembers which keys it was given more than once, and what they replaced."""

    def __init__(self, pairs: list[tuple[str, Any]]):
        super().__init__(pairs)
        counts = Counter(k for k, _ in pairs)
        self.repeated = [k for k, n in counts.items() if n > 1]
        last = {k: i for i, (k, _) in enumerate(pairs)}
        self.replaced = [v for i, (k, v) in enumerate(pairs) if last[k] != i]


def parsed(raw: str) -> tuple[Any, str | None]:
    """(value, fault): fault is bom, syntax with its place, number or depth."""
    try:
        return json.loads(raw, object_pairs_hook=Record), None
    except json.JSONDecodeError as e:
        return None, "bom" if raw.startswith("\ufeff") else f"syntax: line {e.lineno} column {e.colno}"
    except ValueError:
        return None, "number"
    except RecursionError:
        return None, "depth"


def repeated_keys(value: Any) -> list[tuple[str, str]]:
    """(position, key) of the repeated keys, breadth first; those in replaced values come last
    and have the position `replaced`."""
    out: list[tuple[str, str]] = []
    lost: list[Any] = []
    queue = deque([("", value)])
    while queue:
        at, node = queue.popleft()
        if isinstance(node, Record):
            out += [(at, k) for k in node.repeated]
            lost += node.replaced
            queue.extend((f"{at} {k}".strip(), v) for k, v in node.items())
        elif isinstance(node, list):
            queue.extend((f"{at}[{i}]", v) for i, v in enumerate(node))
    while lost:
        node = lost.pop()
        if isinstance(node, Record):
            out += [("replaced", k) for k in node.repeated]
            lost += [*node.replaced, *node.values()]
        elif isinstance(node, list):
            lost += node
    return out


def type_name(value: Any) -> str:
    return {Record: "dict"}.get(type(value), type(value).__name__)
