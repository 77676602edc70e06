"""Layer tables in a relational database."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.operators.analysis import Bound, period_bounds
from vanewatch.operators.quality import for_run
from vanewatch.schemas import RUN, conform, table_info


def postgres_connection(host: str, port: int | str, database: str, user: str, password: str) -> dict:
    """Connection of a PostgreSQL database, as Spark's JDBC options."""
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{database}",
        "user": user,
        "password": password,
        "driver": "org.postgresql.Driver",
    }


def block_splits(blocks: int, parts: int) -> list[str]:
    """Conditions on the row's place in a PostgreSQL table of about so many blocks.

    They are disjoint and cover every row, in blocks added later too.
    """
    parts = max(1, min(parts, blocks))
    bounds = [blocks * i // parts for i in range(1, parts)]
    first = [f"ctid >= '({low},0)'::tid" for low in bounds]
    last = [f"ctid < '({high},0)'::tid" for high in bounds]
    pairs = zip([None, *first], [*last, None])
    return [" AND ".join(c for c in pair if c) or "1 = 1" for pair in pairs]


def quoted(column: str) -> str:
    return '"' + column.replace('"', '""') + '"'


def hash_splits(columns: Iterable[str], parts: int) -> list[str]:
    """Conditions on the hash of some columns, for databases that know ``md5``; every row meets one of them.

    Rows that agree in these columns stay together, and a NULL counts as empty text.
    """
    text = " || '|' || ".join(f"coalesce(cast({column} as varchar(4000)), '')" for column in columns)
    digits = [f"{n:02x}" for n in range(256)]
    parts = max(1, min(parts, len(digits)))
    dealt = [digits[part::parts] for part in range(parts)]
    return [f"substr(md5({text}), 1, 2) in ({', '.join(repr(d) for d in some)})" for some in dealt]


class JdbcStore:
    """Tables ``<layer>.<table>`` reached with the given JDBC options (``url``, ``user``, ...).

    Writing appends, as a database table has no partition to replace; delete a run's rows before
    running its stage again. Each task inserts in a transaction of its own, so a task that is
    repeated after its commit leaves its rows twice. ``connections`` bounds the number of connections that read or write
    at the same time. ``splits`` names, per table, the conditions that divide its scan; they must
    be disjoint and cover every row, rows with NULLs too. For other tables they are derived: PostgreSQL tables are
    divided by block, after a look at their size, others by the hash of all columns.
    """

    # each pass over a table is a query to the database, so intermediate frames are cached
    cheap_rescan = False

    def __init__(
        self,
        spark: SparkSession,
        options: dict[str, str],
        connections: int = 8,
        batch_rows: int = 10_000,
        fetch_rows: int = 10_000,
        splits: dict[str, list[str]] | None = None,
    ):
        if "url" not in options:
            raise ValueError("JDBC options need a url")
        self.spark = spark
        self.url = options["url"]
        self.properties = {key: str(value) for key, value in options.items() if key != "url"}
        self.connections = connections
        self.batch_rows = batch_rows
        # without a fetch size the PostgreSQL driver takes a task's whole result into memory
        self.properties.setdefault("fetchsize", str(fetch_rows))
        self.splits = splits or {}

    def runs(self, table: str) -> list[str]:
        """States of days are not kept in a database, where an index on time does their work."""
        if table == "turbine_daily_state":
            return []
        rows = self.read_all(table).select(RUN).distinct().filter(F.col(RUN).isNotNull())
        return sorted(row[0] for row in rows.collect())

    def name(self, table: str) -> str:
        layer, name, _ = table_info(table)
        return f"{layer}.{name}"

    def write(self, table: str, df: DataFrame, run: str | None, compact: bool = False) -> None:
        """Append the rows of ``run`` in ``df``; ``compact`` has no meaning here.

        No more than ``connections`` tasks write, and without a shuffle before them they also compute ``df``.
        """
        conform(for_run(df, run), table).write.jdbc(
            self.url,
            self.name(table),
            mode="append",
            properties={
                **self.properties,
                "batchsize": str(self.batch_rows),
                "numPartitions": str(self.connections),
            },
        )

    def read(
        self, table: str, run: str | None, period: tuple[Bound, Bound] | None = None
    ) -> DataFrame:
        """Rows of one run; the run condition is evaluated in the database.

        Scans in parallel where ``splits`` or a period on silver tells how.
        """
        options = {}
        if period and table == "silver" and table not in self.splits and self._in_order(period):
            # text options, as the named arguments of the reader take whole numbers only
            options = {
                "partitionColumn": "telemetry_time",
                "lowerBound": str(period[0]),
                "upperBound": str(period[1]),
                "numPartitions": str(self.connections),
            }
        return for_run(self._scan(table, options), run)

    def read_runs(
        self, table: str, runs: Iterable[str | None], period: tuple[Bound, Bound] | None = None
    ) -> DataFrame:
        """Rows of several runs in one frame."""
        runs = list(runs)
        if len(runs) == 1:
            return self.read(table, runs[0], period)
        wanted = F.col(RUN).isin([run for run in runs if run is not None])
        return self.read_all(table).filter(wanted | F.col(RUN).isNull() if None in runs else wanted)

    def _in_order(self, period: tuple[Bound, Bound]) -> bool:
        """Spark refuses a lower bound above the upper one; such a period has no rows anyway."""
        spark = SparkSession.active()
        first, last = period_bounds(spark, *period)
        return bool(spark.range(1).select((first < last).alias("in_order")).first()["in_order"])

    def read_all(self, table: str) -> DataFrame:
        """Rows of every run."""
        return self._scan(table, {})

    def _scan(self, table: str, options: dict) -> DataFrame:
        return self.spark.read.jdbc(
            self.url,
            self.name(table),
            predicates=None if options else self.splits.get(table) or self._derived_splits(table),
            properties={**self.properties, **options},
        )

    def _derived_splits(self, table: str) -> list[str] | None:
        """Splits of a table that none were named for: by block where the database tells its size, else by hash."""
        if self.connections < 2:
            return None
        if not self.url.startswith("jdbc:postgresql:"):
            return hash_splits([quoted(name) for name in table_info(table)[2].names], self.connections)
        size = f"(SELECT pg_relation_size('{self.name(table)}') / current_setting('block_size')::bigint AS blocks) AS size"
        row = self.spark.read.jdbc(self.url, size, predicates=None, properties=self.properties).first()
        return block_splits(int(row["blocks"] or 0), self.connections)
