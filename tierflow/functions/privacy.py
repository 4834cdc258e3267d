"""Sensitivity tags on columns and masking by tag.

Tags live in ``StructField.metadata['pii']``. Spark keeps metadata through
plain column selection and parquet, but drops it through expressions.
``lineage_tags`` finds what an expression was computed from in the analysed
plan, so that a column derived from a tagged one carries its tag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG_KEY = "pii"

# Allowed tag values and the masking constant of each
# policy, exactly as the source defines them (including its spelling).
ALLOWED_TAGS = ("PII", "PRICE", "SENSITIVE", "EMAIL")
MASKS = {
    "PII": "** PII **",
    "EMAIL": "** EAMIL **",
    "SENSITIVE": "** Phone **",
}


def tag(df: DataFrame, tags: dict[str, str]) -> DataFrame:
    """Attach sensitivity tags to columns (metadata only; values unchanged)."""
    for col, value in tags.items():
        if value not in ALLOWED_TAGS:
            raise ValueError(f"tag {value!r} not in {ALLOWED_TAGS}")
        if col in df.columns:
            df = df.withMetadata(col, {TAG_KEY: value})
    return df


def tags_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata[TAG_KEY] for f in df.schema.fields if TAG_KEY in (f.metadata or {})}


#: Of several tags that a column derives from, the first of these counts.
STRICTEST = ("PII", "SENSITIVE", "EMAIL", "PRICE")


def _seq(scala_seq) -> list:
    return [scala_seq.apply(i) for i in range(scala_seq.size())]


def _own_tag(attribute) -> set[str]:
    metadata = attribute.metadata()
    return {metadata.getString(TAG_KEY)} if metadata.contains(TAG_KEY) else set()


def lineage_tags(df: DataFrame) -> dict[str, set[str]]:
    """The tags of all columns that each column of ``df`` derives from.

    Walks the analysed plan from its leaves: an attribute keeps its identity
    through filters, joins and sorts; an alias derives from the attributes its
    expression refers to; the columns of a union from those in the same place; any
    other new column (of a generator, a Python function) from all that the node
    refers to. Conditions that only choose rows pass no tags on. Scalar
    subqueries inside an expression are not followed.
    """
    known: dict[int, set[str]] = {}
    shared: dict[int, list[set[str]]] = {}

    def of(references) -> set[str]:
        return set().union(*(known.get(a.exprId().id(), set()) for a in _seq(references.toSeq())))

    def visit(node) -> None:
        for child in _seq(node.children()):
            visit(child)
        name, outputs = node.nodeName(), _seq(node.output())
        if name == "CTERelationDef":
            shared[node.id()] = [known.get(a.exprId().id(), set()) for a in outputs]
            return
        if name == "CTERelationRef":
            for a, tags in zip(outputs, shared.get(node.cteId(), [])):
                known[a.exprId().id()] = tags | _own_tag(a)
            return
        if name in ("Union", "Intersect", "Except"):
            branches = [[known.get(a.exprId().id(), set()) for a in _seq(c.output())] for c in _seq(node.children())]
            for a, *tags in zip(outputs, *branches):
                known[a.exprId().id()] = set().union(*tags) | _own_tag(a)
            return
        made = {}
        for e in _seq(node.expressions()):
            if e.getClass().getSimpleName() == "Alias":
                made[e.exprId().id()] = of(e.references())
        leaf = not outputs or node.children().isEmpty()
        for a in outputs:
            key = a.exprId().id()
            if key in made:
                known[key] = made[key]
            elif key not in known:
                known[key] = set() if leaf else of(node.references())
            known[key] = known[key] | _own_tag(a)

    plan = df._jdf.queryExecution().analyzed()
    visit(plan)
    return {a.name(): known.get(a.exprId().id(), set()) for a in _seq(plan.output())}


def tag_derived(df: DataFrame) -> DataFrame:
    """Attach to each column the strictest tag of what it derives from."""
    found = {c: next(t for t in STRICTEST if t in tags) for c, tags in lineage_tags(df).items() if tags & set(STRICTEST)}
    return tag(df, found)


def mask_derived(df: DataFrame, unmasked=()) -> DataFrame:
    """Mask every column that is tagged or computed from a tagged one."""
    return mask(tag_derived(df), unmasked=unmasked)


def mask(df: DataFrame, tags: dict[str, str] | None = None, unmasked=()) -> DataFrame:
    """Replace every tagged column by its policy's constant.

    As in the source, the policy returns the constant for any input,
    NULL included. Tags come from ``tags`` or from column metadata;
    columns in ``unmasked`` (e.g. for a privileged reader) stay as they are.
    Tags without a policy (PRICE) leave the column unchanged.
    """
    tags = dict(tags_of(df), **(tags or {}))
    cols = []
    for c in df.columns:
        policy = MASKS.get(tags.get(c, ""))
        if policy is not None and c not in unmasked:
            cols.append(F.lit(policy).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)
