"""Named queries over the star-schema tables, each with its SQL statement if it has one."""

QUERIES = {}
ORACLES = {}


class Tables:
    """The tables of one scale folder: `t.part` reads part.parquet."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name):
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name, sql=None):
    """Register a function of `Tables` under `name`."""
    def register(build):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def select_list(text):
    """Split a select list at its top-level commas."""
    items, depth, quoted, start = [], 0, False, 0
    for i, ch in enumerate(text):
        if ch == "'":
            quoted = not quoted
        elif not quoted:
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 0:
                items.append(text[start:i].strip())
                start = i + 1
    return [*items, text[start:].strip()]
