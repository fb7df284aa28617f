"""Surrogate-key expressions built from native Spark functions.

Both keys stay inside whole-stage codegen: no Python worker is involved, so
they cost the same per row as any other string expression.

* ``uuid5`` -- deterministic name-based key (RFC 9562 version 5): SHA-1 of
  namespace bytes + UTF-8 seed, with version and variant bits set.  A NULL
  seed hashes like the empty string.
* ``uuid7`` -- time-ordered key (RFC 9562 version 7): 48-bit unix
  milliseconds, then the row counter and number of the task, then random bits
  taken from Spark's ``uuid()``.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from chronodim.constants import SEED_SEPARATOR, UUID5_NAMESPACE


def _ns_hex(namespace: str) -> str:
    return namespace.replace("-", "").lower()


def uuid5(seed: Column | str, namespace: str = UUID5_NAMESPACE) -> Column:
    """Version-5 uuid text of ``seed`` under ``namespace``."""
    seed_col = F.col(seed) if isinstance(seed, str) else seed
    payload = F.concat(
        F.unhex(F.lit(_ns_hex(namespace))),
        F.encode(F.coalesce(seed_col.cast("string"), F.lit("")), "UTF-8"),
    )
    h = F.sha1(payload)  # 40 lowercase hex digits; first 32 form the uuid
    # variant bits 10xx: the 17th digit d becomes 8 + (d & 3)
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"),
        F.substring(h, 9, 4), F.lit("-5"),
        F.substring(h, 14, 3), F.lit("-"),
        variant, F.substring(h, 18, 3), F.lit("-"),
        F.substring(h, 21, 12),
    )


def version_seed(keys: list[str], ts: str) -> Column:
    """``key | change time`` text identifying one version of an entity.

    Like SQL ``concat`` it is NULL when any part is NULL.  Timestamps print
    in Spark's cast format (fraction trimmed), the same text the oracle
    produces for ``timestamp_ntz`` in any session zone.
    """
    parts: list[Column] = []
    for k in keys:
        parts += [F.col(k).cast("string"), F.lit(SEED_SEPARATOR)]
    parts.append(F.col(ts).cast("string"))
    return F.concat(*parts)


def uuid7(now: Column | None = None) -> Column:
    """Version-7 uuid text that ascends with the rows of a task: ``now`` in unix
    ms (default: query start time), a 24-bit row counter of the task, 18 bits of
    the task's number, 32 random bits.  A counter that runs over adds a
    millisecond.  Tasks of a query differ by their numbers, queries of the
    same millisecond by the random bits.

    Non-deterministic: materialize before reusing."""
    def ms() -> Column:  # a counter of its own for each mention
        return F.unix_millis(F.current_timestamp() if now is None else now.cast("timestamp")) + F.expr(_CARRY)

    return F.lower(F.concat(F.lpad(F.hex(F.shiftright(ms(), 16)), 8, "0"), F.lit("-"), F.lpad(F.hex(ms().bitwiseAND(F.lit(65535))), 4, "0"), F.expr(_UUID7_TAIL)))


# Row and task from the row number Spark gives (task << 33 | row).  Each mention
# counts on its own; all are evaluated for every key, so they agree.
_ROW = "(monotonically_increasing_id() & 8589934591L)"
_TASK = "(shiftright(monotonically_increasing_id(), 33) & 262143L)"
_CARRY = f"shiftright({_ROW}, 24)"
# version and counter bits 23..12; variant, counter bits 11..0 and task; random bits
_UUID7_TAIL = (
    f"concat('-7', lpad(hex(shiftright({_ROW}, 12) & 4095L), 3, '0'), "
    f"'-', hex(32768L | shiftleft({_ROW} & 4095L, 2) | shiftright({_TASK}, 16)), "
    f"'-', lpad(hex({_TASK} & 65535L), 4, '0'), substr(uuid(), 1, 8))"
)


def uuid5_sql_body(namespace: str = UUID5_NAMESPACE, seed: str = "seed") -> str:
    """SQL text of :func:`uuid5` over the SQL expression ``seed``."""
    h = f"sha1(concat(unhex('{_ns_hex(namespace)}'), encode(coalesce(cast({seed} as string), ''), 'UTF-8')))"
    return (
        f"concat(substr({h}, 1, 8), '-', substr({h}, 9, 4), '-5', substr({h}, 14, 3), '-', "
        f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab'), substr({h}, 18, 3), '-', "
        f"substr({h}, 21, 12))"
    )


UUID7_SQL_BODY = (
    f"lower(concat(lpad(hex(shiftright(unix_millis(current_timestamp()) + {_CARRY}, 16)), 8, '0'), '-', "
    f"lpad(hex((unix_millis(current_timestamp()) + {_CARRY}) & 65535L), 4, '0'), {_UUID7_TAIL}))"
)


def register_sql_functions(spark: SparkSession, namespace: str = UUID5_NAMESPACE) -> None:
    """Expose ``uuid5_sk(seed)`` and ``uuid7()`` to SQL as SQL functions
    (bodies are plain expressions, so SQL callers keep codegen too)."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION uuid5_sk(seed STRING) RETURNS STRING RETURN "
        + uuid5_sql_body(namespace, "seed")
    )
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION uuid7() RETURNS STRING RETURN " + UUID7_SQL_BODY)
