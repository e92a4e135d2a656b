"""Where the sources are and what the tables are called."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    """Paths of the source files and three-part names of the tables made from them."""

    sources: dict[str, str]
    catalog: str = "spark_catalog"
    schema: str = "raw"
    formats: dict[str, str] = field(default_factory=dict)
    read_options: dict[str, dict[str, str]] = field(default_factory=dict)
    location: str | None = None  # folder for external tables; managed tables if not given
    batch: str | None = None  # name of the load; growing tables and the quarantine then keep the other loads
    growing: tuple[str, ...] = ("orders",)  # datasets that come in loads; others are replaced by each

    def table(self, name: str) -> str:
        return f"{self.catalog}.{self.schema}.{name}"

    def path(self, name: str) -> str | None:
        return None if self.location is None else f"{self.location}/{name}"

    @property
    def quarantine_table(self) -> str:
        return self.table("quarantine")
