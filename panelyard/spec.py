"""Settings: column roles, thresholds and calendars, validated before any work."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, timedelta

from panelyard.functions.calendar import Calendar

# Landing columns that are numbers, and those that carry nothing.
NUMERIC_COLUMNS = ("quantidade", "valorUnitarioEstimado", "valorTotal",
                   "valorTotalResultado")
DEAD_COLUMNS = ("itemCategoriaNome", "temResultado", "codigoGrupo")

# Labels that appear in the results.
OTHER_CLASSES = "Outras"
NO_CLASS = "Sem classe"
REASON_VALUE = "valor total implausível para um item de linha"

# The equality filters a feed may be narrowed by, and the setting
# each one is read from.
SOURCE_FILTERS = {
    "materialOuServico": "MATERIAL_OR_SERVICE",
    "situacaoCompraItem": "ITEM_STATUS",
    "temResultado": "HAS_RESULT",
    "orgaoEntidadeCnpj": "ORGAN_CNPJ",
    "unidadeOrgaoCodigoUnidade": "UNIT_CODE",
    "codigoGrupo": "ITEM_GROUP",
    "codigoClasse": "ITEM_CLASS",
    "codItemCatalogo": "CATALOG_ITEM",
    "codFornecedor": "SUPPLIER_ID",
}


class SpecError(ValueError):
    """A setting is missing, malformed or out of range."""


@dataclass(frozen=True)
class ItemColumns:
    """Which column of the item table plays which role."""

    item_id: str = "idCompraItem"
    included_at: str = "dataInclusaoPncp"
    kind: str = "materialOuServicoNome"
    class_code: str = "codigoClasse"
    status: str = "situacaoCompraItemNome"
    quantity: str = "quantidade"
    unit_estimate: str = "valorUnitarioEstimado"
    estimated: str = "valorTotal"
    awarded: str = "valorTotalResultado"
    supplier: str = "nomeFornecedor"
    organ: str = "orgaoEntidadeCnpj"
    category: str = "itemCategoriaNome"
    description: str = "descricaoResumida"


@dataclass(frozen=True)
class PanelSpec:
    """Everything the preparation stages need to know.

    ``sum_scale`` switches money sums from double (order-dependent in the last
    bits) to decimals of that scale, whose totals do not depend on how the rows
    were partitioned.
    """

    columns: ItemColumns = field(default_factory=ItemColumns)
    freq: str = "W"
    top_classes: int = 50
    status: str = "Homologado"
    ceiling: float = 10_000_000_000.0
    sum_scale: int | None = None

    def __post_init__(self) -> None:
        Calendar.of(self.freq)
        _at_least("TOP_CLASSES", self.top_classes, 1)
        _at_least("VALUE_CEILING", self.ceiling, 1.0)
        if self.sum_scale is not None and not 0 <= self.sum_scale <= 12:
            raise SpecError(f"SUM_SCALE must be between 0 and 12, got {self.sum_scale}")

    @classmethod
    def from_mapping(cls, values: Mapping[str, str]) -> PanelSpec:
        """Reads the settings from text values, such as ``os.environ``."""
        read = _Reader(values)
        return cls(
            freq=read.text("PANEL_FREQ", "W"),
            top_classes=read.whole("TOP_CLASSES", 50),
            status=read.text("STATUS_FILTER", "Homologado"),
            ceiling=read.real("VALUE_CEILING", 10_000_000_000.0),
        )


@dataclass(frozen=True)
class Layers:
    """Where each stage of the preparation keeps its result, under one root."""

    root: str = "data"
    raw_name: str = "contract_items.csv"

    @classmethod
    def from_mapping(cls, values: Mapping[str, str]) -> Layers:
        read = _Reader(values)
        return cls(read.text("DATA_DIR", "data"), read.text("RAW_CSV_NAME", "contract_items.csv"))

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/{self.raw_name}"

    @property
    def unique(self) -> str:
        return f"{self.root}/interim/itens_unicos.parquet"

    @property
    def known(self) -> str:
        """Unique items of a collected table, run by run, and the index of their ids."""
        return f"{self.root}/interim/itens_conhecidos"

    @property
    def rejects(self) -> str:
        return f"{self.root}/interim/rejeitados.parquet"

    @property
    def kept(self) -> str:
        return f"{self.root}/interim/itens_limpos.parquet"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/interim/quarentena.parquet"

    @property
    def panel(self) -> str:
        return f"{self.root}/processed/painel.parquet"

    @property
    def features(self) -> str:
        return f"{self.root}/processed/painel_features.parquet"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}.parquet"


@dataclass(frozen=True)
class CollectSpec:
    """The date window, chunk width, filters and columns of one ingestion."""

    end_date: date
    window_days: int = 365
    chunk_days: int = 7
    filters: Mapping[str, str] = field(default_factory=dict)
    columns: tuple[str, ...] = ()
    resume: bool = True
    top_items: int = 20

    def __post_init__(self) -> None:
        _at_least("WINDOW_DAYS", self.window_days, 1)
        _at_least("CHUNK_DAYS", self.chunk_days, 1)
        _at_least("TOP_ITEMS", self.top_items, 1)
        unknown = set(self.filters) - set(SOURCE_FILTERS)
        if unknown:
            raise SpecError(f"unknown filters: {sorted(unknown)}")
        kind = self.filters.get("materialOuServico")
        if kind not in (None, "M", "S"):
            raise SpecError(f"MATERIAL_OR_SERVICE takes only M or S, got {kind!r}")

    @property
    def start_date(self) -> date:
        return self.end_date - timedelta(days=self.window_days)

    @classmethod
    def from_mapping(cls, values: Mapping[str, str], today: date) -> CollectSpec:
        read = _Reader(values)
        filters = {name: read.text(key) for name, key in SOURCE_FILTERS.items() if read.text(key)}
        if "materialOuServico" in filters:
            filters["materialOuServico"] = filters["materialOuServico"].upper()
        return cls(
            end_date=read.day("END_DATE", today),
            window_days=read.whole("WINDOW_DAYS", 365),
            chunk_days=read.whole("CHUNK_DAYS", 7),
            filters=filters,
            columns=read.names("COLUMNS"),
            resume=read.flag("RESUME", True),
            top_items=read.whole("TOP_ITEMS", 20),
        )


def _at_least(name: str, value: float, floor: float) -> None:
    if value < floor:
        raise SpecError(f"{name} must be at least {floor}, got {value}")


class _Reader:
    """Typed look-ups in a text mapping; blank counts as absent."""

    # The accepted spellings of a flag.
    TRUE = ("true", "1", "sim", "yes")
    FALSE = ("false", "0", "nao", "não", "no")

    def __init__(self, values: Mapping[str, str]):
        self.values = values

    def text(self, key: str, default: str = "") -> str:
        return (self.values.get(key) or "").strip() or default

    def _parsed(self, key, default, parse, wanted):
        raw = self.text(key)
        if not raw:
            return default
        try:
            return parse(raw)
        except ValueError:
            raise SpecError(f"{key} must be {wanted}, got {raw!r}") from None

    def whole(self, key: str, default: int) -> int:
        return self._parsed(key, default, int, "a whole number")

    def real(self, key: str, default: float) -> float:
        return self._parsed(key, default, float, "a number")

    def day(self, key: str, default: date) -> date:
        return self._parsed(key, default, date.fromisoformat, "a date such as 2025-01-31")

    def flag(self, key: str, default: bool) -> bool:
        raw = self.text(key).lower()
        if raw and raw not in self.TRUE + self.FALSE:
            raise SpecError(f"{key} must be true or false, got {raw!r}")
        return raw in self.TRUE if raw else default

    def names(self, key: str) -> tuple[str, ...]:
        return tuple(part for part in re.split(r"\s*,\s*", self.text(key)) if part)
