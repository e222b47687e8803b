"""SQL fragments shared by the query twins."""

CSN = "PAT_ENC_CSN_ID"


def ids(values) -> str:
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def minute(x: str) -> str:
    """Nearest minute."""
    return f"date_trunc('minute', {x} + INTERVAL 30 SECOND)"


def second(x: str) -> str:
    return f"date_trunc('second', {x} + INTERVAL 500 MILLISECOND)"


def escaped(x: str) -> str:
    return (
        f"replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),"
        " chr(13), '&#x0D;')"
    )


def stamp(x: str) -> str:
    return f"coalesce(strftime({x}, '%Y-%m-%d %H:%M:%S'), '')"


def text(x: str, width: int) -> str:
    return f"coalesce(left(CAST({x} AS VARCHAR), {width}), '')"


def pseudonym(x: str, width: int) -> str:
    return f"coalesce(upper(sha256(left(CAST({x} AS VARCHAR), {width}))), '')"


def line_list(
    table: str, key: str, line: str, value: str, name: str, trailing: bool = True, raw: bool = False
) -> str:
    """Lines of a table as one whole text per key, null lines empty."""
    item = f"coalesce({value}, '')"
    item = item if raw else escaped(item)
    joined = f"string_agg({item}, '|' ORDER BY {line})" + (" || '|'" if trailing else "")
    return f"SELECT {key}, {joined} AS {name} FROM {table} GROUP BY {key}"
