"""SQL text that puts table columns into XML records."""

NULL = "CAST(NULL AS STRING)"


def element(**children: str) -> str:
    """A nested element from SQL snippets; attributes are named ``_x``, text ``_VALUE``."""
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in children.items()) + ")"


def some(*elements: str) -> str:
    """A repeated element, leaving out those that are null."""
    return f"filter(array({', '.join(elements)}), e -> e IS NOT NULL)"


def several(*elements: str) -> str:
    return f"array({', '.join(elements)})"


def only_if(cond: str, value: str) -> str:
    return f"CASE WHEN {cond} THEN {value} END"


def xml(tag: str, **children: str) -> str:
    """The record as XML text, in a column named ``xml``."""
    return f"to_xml({element(**children)}, map('rowTag', '{tag}')) AS xml"
