"""Record layouts: which columns a layer holds and what role each one plays.

A layout is plain data. Every operator takes one, so the same code serves the
complaint records (the default) and any other keyed, versioned record stream.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# The raw record columns, in positional order, as the CSV export
# and the topic messages carry them.
COMPLAINT_COLUMNS = (
    "date_received",
    "product",
    "sub_product",
    "issue",
    "sub_issue",
    "complaint_what_happened",
    "company_public_response",
    "company",
    "state",
    "zip_code",
    "tags",
    "submitted_via",
    "date_sent_to_company",
    "company_response",
    "timely",
    "complaint_id",
)

# Display headers of the daily feed CSV and the raw column each
# one maps to. Matching is by header name, so column order in a file is free.
FEED_HEADERS = (
    ("Date received", "date_received"),
    ("Product", "product"),
    ("Sub-product", "sub_product"),
    ("Issue", "issue"),
    ("Sub-issue", "sub_issue"),
    ("Consumer complaint narrative", "complaint_what_happened"),
    ("Company public response", "company_public_response"),
    ("Company", "company"),
    ("State", "state"),
    ("ZIP code", "zip_code"),
    ("Tags", "tags"),
    ("Submitted via", "submitted_via"),
    ("Date sent to company", "date_sent_to_company"),
    ("Company response to consumer", "company_response"),
    ("Timely response?", "timely"),
    ("Complaint ID", "complaint_id"),
)


@dataclass(frozen=True)
class Layout:
    """Column roles of a layered record table.

    raw           text columns of the first layer, in positional order
    key           record key (upsert match, latest-version grouping)
    batch         load-batch marker (which loads a layer has seen)
    version       ordering of versions of one key (newest wins)
    tiebreak      extra ordering columns that make "newest" unique
    date          the column whose date decides validity and the partition
    dates         raw text columns typed to DATE from the second layer on
    partition     derived partition column (text year of ``date``)
    origin        lineage column naming the source (csv / api / kafka)
    carry         extra typed columns carried unchanged through every layer
    """

    raw: tuple[str, ...] = COMPLAINT_COLUMNS
    key: str = "complaint_id"
    batch: str = "creation_time"
    version: str = "creation_time"
    tiebreak: tuple[str, ...] = ()
    date: str = "date_received"
    dates: tuple[str, ...] = ("date_received", "date_sent_to_company")
    partition: str = "complaint_year"
    origin: str = "data_source"
    carry: tuple[str, ...] = ()
    state: str = "state"
    company: str = "company"
    feed_headers: tuple[tuple[str, str], ...] = field(default=FEED_HEADERS)

    def with_(self, **changes) -> "Layout":
        return replace(self, **changes)

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.raw])

    @property
    def bronze_columns(self) -> list[str]:
        cols = [*self.raw, *self.carry, self.origin, self.batch]
        return list(dict.fromkeys(cols))

    @property
    def typed_columns(self) -> list[str]:
        """Silver / gold column order: partition first, then the bronze columns."""
        return [self.partition, *self.bronze_columns]

    def bronze_schema(
        self, carry_types: dict[str, T.DataType] | None = None, batch_type: T.DataType | None = None
    ) -> T.StructType:
        """First-layer schema: raw text, carry columns (typed by the caller),
        origin text, batch marker (TIMESTAMP unless ``batch_type`` says)."""
        carry_types = carry_types or {}
        fields = []
        for c in self.bronze_columns:
            if c == self.batch:
                t = batch_type or T.TimestampType()
            elif c in self.carry:
                t = carry_types.get(c, T.StringType())
            else:
                t = T.StringType()
            fields.append(T.StructField(c, t, True))
        return T.StructType(fields)

    def typed_schema(
        self, carry_types: dict[str, T.DataType] | None = None, batch_type: T.DataType | None = None
    ) -> T.StructType:
        """Second/third-layer schema: partition year text first, date columns
        DATE, the rest as in the first layer."""
        fields = [T.StructField(self.partition, T.StringType(), True)]
        for f in self.bronze_schema(carry_types, batch_type).fields:
            fields.append(T.StructField(f.name, T.DateType(), True) if f.name in self.dates else f)
        return T.StructType(fields)

    @property
    def order(self) -> list[str]:
        return list(dict.fromkeys([self.version, *self.tiebreak]))


COMPLAINTS = Layout()
