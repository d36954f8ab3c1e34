"""Put the common table expressions a statement needs in front of it."""

from __future__ import annotations

import re
from collections.abc import Mapping


def compose(ctes: Mapping[str, str], statement: str) -> str:
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for word in re.findall(r"[a-z_][a-z0-9_]*", sql):
            if word in ctes and word not in ordered:
                visit(ctes[word])
                if word not in ordered:
                    ordered.append(word)

    visit(statement)
    if not ordered:
        return statement
    return "WITH " + ",\n".join(f"{name} AS (\n{ctes[name]}\n)" for name in ordered) + "\n" + statement
