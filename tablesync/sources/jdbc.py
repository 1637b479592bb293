"""Options and query texts for reading a database through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Fixed value: the MySQL driver streams a result row by row at this fetch size
# instead of holding it whole in the task's memory.
MYSQL_STREAMING_FETCH = -2147483648

# The slot for predicates in a query, and what fills it without any.
CONDITIONS = "$CONDITIONS"
ALWAYS_TRUE = "(1 = 1)"


@dataclass(frozen=True)
class JdbcSource:
    """A database, and optionally the table in it that is read.

    ``sessionInitStatement`` and any other option of Spark's JDBC source can be
    passed in ``properties``; a decimal wider than 38 digits needs
    ``properties={"customSchema": "col STRING"}``.
    """

    url: str
    table: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    fetchsize: int | None = None
    relaxed_isolation: bool = False
    properties: Mapping[str, str] = field(default_factory=dict)

    @property
    def is_mysql(self) -> bool:
        return self.url.startswith(("jdbc:mysql:", "jdbc:mariadb:"))

    def quote(self, name: str) -> str:
        mark = "`" if self.is_mysql else '"'
        return mark + name.replace(mark, mark * 2) + mark

    def literal(self, value) -> str:
        """A value as SQL text; everything but a number is quoted."""
        text = str(value)
        if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
            return text
        return "'" + text.replace("'", "''") + "'"

    def options(self, **read: str) -> dict[str, str]:
        """Reader options: connection first, then ``dbtable=``/``query=`` and splits."""
        opts = {"url": self.url}
        for name in ("user", "password", "driver"):
            value = getattr(self, name)
            if value is not None:
                opts[name] = value
        fetchsize = self.fetchsize
        if fetchsize is None and self.is_mysql:
            fetchsize = MYSQL_STREAMING_FETCH
        if fetchsize is not None:
            if fetchsize < 0 and not self.is_mysql:
                raise ValueError("a negative fetchsize is only understood by MySQL drivers")
            opts["fetchsize"] = str(fetchsize)
        if self.relaxed_isolation:
            if not self.is_mysql and "sessionInitStatement" not in self.properties:
                raise ValueError("relaxed_isolation needs properties['sessionInitStatement'] here")
            opts["sessionInitStatement"] = "SET SESSION TRANSACTION ISOLATION LEVEL READ UNCOMMITTED"
        opts.update(self.properties)
        opts.update(read)
        return opts

    def relation(self, query: str | None = None, where: str | None = None) -> str:
        """What goes into ``dbtable``: the quoted table, or a subquery named t1.

        Spark refuses ``query`` together with range splits, so subqueries always
        travel as ``dbtable``. Column lists need no text: Spark asks the database
        only for the columns the plan uses.
        """
        if query is not None:
            return f"({fill_conditions(query, where)}) t1"
        if self.table is None:
            raise ValueError("a table or a query is required")
        if where is None:
            return self.quote(self.table)
        return f"(SELECT * FROM {self.quote(self.table)} WHERE ({where})) t1"

    def bounds_query(self, column: str, query: str | None = None, where: str | None = None) -> str:
        """MIN and MAX computed by the database (``dbtable`` reads would ship all rows)."""
        col = self.quote(column)
        return f"SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {self.relation(query, where)}"

    def max_query(self, column: str, query: str | None = None, where: str | None = None) -> str:
        return f"SELECT MAX({self.quote(column)}) AS max_value FROM {self.relation(query, where)}"


def fill_conditions(query: str, conditions: str | None = None) -> str:
    """Put split/incremental predicates into the query's slot, ``(1 = 1)`` if there are none."""
    if conditions is not None:
        if CONDITIONS not in query:
            raise ValueError(f"the query needs a {CONDITIONS} slot to take conditions")
        return query.replace(CONDITIONS, f"({conditions})")
    return query.replace(CONDITIONS, ALWAYS_TRUE)
