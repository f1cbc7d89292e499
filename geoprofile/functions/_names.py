"""Column names as SQL identifiers."""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
