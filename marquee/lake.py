"""Bronze, silver and gold locations under one root."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LakePaths:
    root: str

    def bronze(self, table: str) -> str:
        return self._at("bronze", table)

    def silver(self, table: str) -> str:
        return self._at("silver", table)

    def gold(self, table: str) -> str:
        return self._at("gold", table)

    def _at(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"
