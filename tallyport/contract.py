"""The declared contract of a delivery, held on the driver and compiled to expressions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession, types as T

from tallyport.functions import datatypes

# Column headings of contract files and the names used here.
CONTRACT_FIELDS = {
    "kolomnaam": "name",
    "datatype": "datatype",
    "constraints": "constraints",
    "domein": "domain",
    "verstek": "default",
    "keytype": "key",
    "leverancier_kolomnaam": "supplier_name",
    "leverancier_kolomtype": "supplier_type",
}
GENERATED = [
    T.StructField("record_no", T.LongType()),
    T.StructField("source_code", T.StringType()),
    T.StructField("period", T.StringType()),
    T.StructField("valid_from", T.DateType()),
    T.StructField("valid_to", T.DateType()),
    T.StructField("loaded_at", T.TimestampType()),
]
GENERATED_NAMES = [f.name for f in GENERATED]


class ContractError(ValueError):
    """The delivery or the contract cannot be processed at all."""


@dataclass(frozen=True)
class ContractColumn:
    name: str
    datatype: str = "text"
    constraints: str = ""
    domain: str = ""
    default: str | None = None
    key: str = ""
    supplier_name: str = ""
    supplier_type: str = ""
    precision: int = 38
    scale: int = 10

    @property
    def nullable(self) -> bool:
        return "NOT NULL" not in self.constraints.upper()

    @property
    def base(self) -> str:
        return datatypes.base_type(self.datatype)


@dataclass(frozen=True)
class Contract:
    columns: tuple[ContractColumn, ...]
    source_code: str = ""
    frequency: str = ""
    decimal_sign: str = "."
    keys: tuple[str, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def __getitem__(self, name: str) -> ContractColumn:
        return next(c for c in self.columns if c.name == name)

    def of_type(self, *wanted: str) -> list[str]:
        return [c.name for c in self.columns if c.datatype in wanted]

    def of_base(self, *wanted: str) -> list[str]:
        return [c.name for c in self.columns if c.base in wanted]

    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType()) for n in self.names])

    def typed_schema(self) -> T.StructType:
        typed = [
            T.StructField(
                c.name, datatypes.spark_type(c.datatype, c.precision, c.scale)
            )
            for c in self.columns
        ]
        return T.StructType(GENERATED + typed)

    @staticmethod
    def of(*columns: ContractColumn, **settings) -> Contract:
        keys = settings.pop("keys", None) or tuple(
            c.name for c in columns if c.key.strip().upper().startswith("PRIMARY")
        )
        names = [c.name for c in columns]
        if len(set(names)) < len(names):
            raise ContractError(f"duplicate columns in contract: {names}")
        return Contract(tuple(columns), keys=tuple(keys), **settings)

    @staticmethod
    def read(
        spark: SparkSession,
        path: str,
        supplier_types: dict[str, str] | None = None,
        **settings,
    ) -> Contract:
        """Contract from a `;` separated file with one row per column."""
        types = datatypes.SUPPLIER_TYPES if supplier_types is None else supplier_types
        rows = (
            spark.read.options(header=True, sep=";", emptyValue="", nullValue="\x00")
            .csv(path)
            .collect()
        )
        columns = []
        for row in rows:
            given = {
                ours: (row[theirs] or "").strip()
                for theirs, ours in CONTRACT_FIELDS.items()
                if theirs in row.__fields__
            }
            if given["name"] in GENERATED_NAMES:
                continue
            given["datatype"] = (
                given.get("datatype", "").lower()
                or types.get(given.get("supplier_type", ""), "text")
            )
            given["default"] = given.get("default") or default_in(given["constraints"])
            columns.append(ContractColumn(**given))
        return Contract.of(*columns, **settings)


def default_in(constraints: str) -> str | None:
    """The value of a `DEFAULT x` clause."""
    words = constraints.split()
    upper = [w.upper() for w in words]
    if "DEFAULT" not in upper:
        return None
    return words[upper.index("DEFAULT") + 1].strip("'\"")
