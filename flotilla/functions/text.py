"""Text expressions: log-line fields (P14) and alert descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flotilla import schemas as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_parts(line) -> Column:
    """Split on one space into at most four parts."""
    line = F.col(line) if isinstance(line, str) else line
    return F.split(line, " ", 4)


def log_fields(parts: Column) -> dict[str, Column]:
    """``timestamp, nivel, componente, mensaje`` from the four parts of a log line.

    ``timestamp`` = parts 1 and 2; ``nivel`` = part 3 without surrounding brackets;
    ``componente`` = part 4 up to the first ``]`` without a leading/trailing ``[``;
    ``mensaje`` = the text after the first ``]``, whitespace-trimmed, or all of part 4
    when it has no ``]``.
    """
    rest = parts[3]
    after = F.substr(rest, F.locate("]", rest) + F.lit(1))
    return {
        "timestamp": F.concat(parts[0], F.lit(" "), parts[1]),
        "nivel": F.trim(parts[2], F.lit("[]")),
        "componente": F.trim(F.substring_index(rest, "]", 1), F.lit("[")),
        "mensaje": F.when(F.contains(rest, F.lit("]")),
                          F.regexp_replace(after, r"^\s+|\s+$", ""))
                    .otherwise(rest),
    }


def alert_speed_text(plate, speed) -> Column:
    """``Vehículo {plate} a {speed} km/h``; null when a part is null (concat semantics)."""
    a, b, c = S.SPEED_TEXT
    return F.concat(F.lit(a), _c(plate), F.lit(b), _c(speed).cast("string"), F.lit(c))


def alert_route_text(km) -> Column:
    """``Desviación de {km} km detectada``."""
    a, b = S.ROUTE_TEXT
    return F.concat(F.lit(a), _c(km).cast("string"), F.lit(b))

