"""Column classification and masking.

Classification lives in ``StructField.metadata`` so it travels with the
schema into every written Parquet file. It follows the data: a column of any table
that is made from a ``pii`` column (renamed, cut, joined to other text) is found by
walking the analysed plan from the column back to the tagged one, and tagged too.
Masking replaces each column tagged ``pii`` by its HMAC-SHA-256 under a key of the
caller's, so joins on the masked value still work, and identifiers can't be found by
trying them all without the key. ``Lakehouse.refresh`` writes classified tables with
their tags and a masked copy of each; ``publishable`` refuses clear ``pii`` columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed classification of the HCP profile.
PII_COLUMNS = {"npi": "pii"}
CLASSIFIED_TABLES = ["silver_hcp", "hcp_360"]
TABLE_TAGS = {"layer": "gold", "serving": "analytics"}


def classify(df: DataFrame, tags: dict[str, str] = PII_COLUMNS) -> DataFrame:
    """Attach the table tags to every column and ``classification`` to the tagged ones."""
    for found in (TABLE_TAGS, *({"classification": t} for t in tags.values())):
        check_tags(found)
    return df.select(*[
        F.col(c).alias(c, metadata=TABLE_TAGS | ({"classification": tags[c]} if c in tags else {}))
        for c in df.columns])


def pii_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.metadata.get("classification") == "pii"]


ALLOWED_TAGS = {"classification": {"internal", "pii"}, "layer": {"bronze", "silver", "gold"}, "serving": {"analytics", "operational"}}


def check_tags(tags: dict[str, str]) -> None:
    """Only known tags with allowed values are accepted."""
    for name, value in tags.items():
        if value not in ALLOWED_TAGS.get(name, ()):
            raise ValueError(f"tag {name}={value!r} is not allowed")


def derived_columns(df: DataFrame, sources: dict[str, str] = PII_COLUMNS) -> dict[str, str]:
    """Output columns of ``df`` whose values are made from a source column, with the source's classification.

    Sources are columns of the plan's leaves: those tagged in their metadata, or named in ``sources``. Every operator
    of the analysed plan that gives an attribute a new expression (projections, aggregates, generators, unions, windows)
    passes the classification of what it refers to on; values that only filter, group elsewhere or join don't count.
    Counts of a source carry no value of it.
    """
    plan = df._jdf.queryExecution().analyzed()
    known: dict[int, str | dict] = {}   # by attribute; of a struct, by field

    def items(seq) -> list:
        return [seq.apply(i) for i in range(seq.size())]

    def flat(found: str | dict | None) -> str | None:
        return next((t for t in map(flat, found.values()) if t), None) if isinstance(found, dict) else found

    def of_expression(e) -> str | dict | None:
        kind, children = e.getClass().getSimpleName(), items(e.children())
        if kind == "Count":
            return None
        if kind == "AttributeReference":
            return known.get(e.exprId().id())
        if kind == "CreateNamedStruct":
            pairs = ((name.value().toString(), of_expression(value)) for name, value in zip(children[::2], children[1::2]))
            return {name: found for name, found in pairs if found} or None
        if kind == "GetStructField":
            found = of_expression(children[0])
            return found.get(e.childSchema().apply(e.ordinal()).name()) if isinstance(found, dict) else found
        if kind in ("MaxBy", "MinBy"):   # the order chooses the value, but is no part of it
            return of_expression(children[0])
        found = [f for f in map(of_expression, children) if f]
        return found[0] if len(children) == 1 and found else next(map(flat, found), None)

    def visit(node) -> None:
        for child in items(node.children()):
            visit(child)
        kind = node.getClass().getSimpleName()
        if node.children().isEmpty():
            for a in items(node.output()):
                meta = a.metadata()
                tag = meta.getString("classification") if meta.contains("classification") else sources.get(a.name())
                if tag and tag != "internal":
                    known[a.exprId().id()] = tag
            return
        if kind == "Union":
            outputs = [items(c.output()) for c in items(node.children())]
            for i, a in enumerate(items(node.output())):
                tag = next((known[o[i].exprId().id()] for o in outputs if o[i].exprId().id() in known), None)
                if tag:
                    known[a.exprId().id()] = tag
            return
        if kind == "Generate":
            tag = of_expression(node.generator())
            if tag:
                known.update({a.exprId().id(): tag for a in items(node.generatorOutput())})
            return
        for e in items(node.expressions()):
            for named in ([e] if e.getClass().getSimpleName() == "Alias" else []):
                tag = of_expression(named.child())
                if tag:
                    known[named.exprId().id()] = tag

    visit(plan)
    return {a.name(): flat(known[a.exprId().id()]) for a in items(plan.output()) if a.exprId().id() in known}


def classify_derived(df: DataFrame, sources: dict[str, str] = PII_COLUMNS) -> DataFrame:
    """``classify`` with the columns that derive from the sources."""
    return classify(df, derived_columns(df, sources))


def publishable(df: DataFrame, sources: dict[str, str] = PII_COLUMNS) -> DataFrame:
    """``df``, or an error when a column holds clear values of a classified source: mask it first."""
    clear = sorted(c for c, tag in derived_columns(df, sources).items() if tag == "pii" and df.schema[c].metadata.get("masked") != "true")
    if clear:
        raise ValueError(f"columns {clear} hold pii; mask them before publishing")
    return df


def keyed_hash(value: Column, key: str) -> Column:
    """HMAC-SHA-256 (hex) of a string column; the key has at most 64 bytes."""
    block = key.encode()
    if not 0 < len(block) <= 64:
        raise ValueError("a key of 1 to 64 bytes is needed")
    inner, outer = (bytearray(b ^ pad for b in block.ljust(64, b"\0")) for pad in (0x36, 0x5C))
    first = F.sha2(F.concat(F.lit(inner), F.encode(value, "utf-8")), 256)
    return F.sha2(F.concat(F.lit(outer), F.unhex(first)), 256)


def mask(df: DataFrame, key: str) -> DataFrame:
    """Replace every pii-tagged column by its keyed hash (NULL stays NULL)."""
    tagged = set(pii_columns(df))
    return df.select(*[
        keyed_hash(F.col(c).cast("string"), key).alias(c, metadata=df.schema[c].metadata | {"masked": "true"}) if c in tagged else F.col(c)
        for c in df.columns])
