"""The invoice-payment join, safe against one invoice holding most of the payments.

Adaptive execution splits an oversized shuffle partition of a left outer join
only on the left. Payments are on the right, so a hot payment key would land in
one task. Written as matched rows plus unmatched rows, the same result comes from
an inner join, where either side may be split, and an anti join on distinct keys,
which combines before it shuffles. There is no other form: no statistics are
gathered first, and no job runs before the plan is used.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("id_cliente", "id_fatura")


def left_join_split(left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Left outer join as inner join plus anti join. A NULL key matches nothing, as in any join.

    The sides may share no column names but ``keys``.
    """
    keys = list(keys)
    extra = [c for c in right.columns if c not in keys]
    empty = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in extra]
    complete = F.expr(" and ".join(f"{k} is not null" for k in keys))

    # Both joins read the same rows in the same order of columns, so they share one shuffle.
    keyed = left.where(complete)
    matched = keyed.join(right, keys, "inner").select(*left.columns, *extra)
    paid = right.select(*keys).distinct()
    unmatched = keyed.join(paid, keys, "left_anti").unionByName(left.where(~complete))
    return matched.unionByName(unmatched.select(*left.columns, *empty))


# Columns in the order they are stored, see left_join_split.
_INVOICE = ("id_fatura", "id_cliente", "dt_emissao", "dt_vencimento", "vlr_fatura", "vlr_pagto_min")
_PAYMENT = ("id_pagamento", "id_fatura", "id_cliente", "dt_pagamento", "vlr_pagamento")
_JOINED = (
    "id_cliente",
    "id_fatura",
    "dt_emissao",
    "dt_vencimento",
    "vlr_fatura",
    "vlr_pagto_min",
    "id_pagamento",
    "dt_pagamento",
    "vlr_pagamento",
)


def join_faturas_pagamentos(faturas: DataFrame, pagamentos: DataFrame) -> DataFrame:
    """Every invoice with each of its payments; unpaid ones with NULL payment columns.

    An invoice with several payments repeats, amount included.
    """
    return left_join_split(faturas.select(*_INVOICE), pagamentos.select(*_PAYMENT)).select(*_JOINED)


def apart_from_hot(hot: str, *sides: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """``sides`` without the keys that any row marks in the column ``hot``, and the rows of these keys.

    The marked keys are fewer than the buckets of the tables, and broadcast. A row without a key is among the first.
    """
    marked = reduce(DataFrame.unionByName, [side.where(F.col(hot) == 1).select(*KEYS) for side in sides])
    keys = F.broadcast(marked.distinct())
    rest = [side.where(F.col(hot) == 0).join(keys, list(KEYS), "left_anti") for side in sides]
    return rest, [side.join(keys, list(KEYS), "left_semi") for side in sides]


def join_stored(faturas: DataFrame, pagamentos: DataFrame, hot: str | None = None) -> DataFrame:
    """As ``join_faturas_pagamentos``, of tables bucketed by the keys: nothing is shuffled but the rows of hot keys.

    ``hot`` names the column that marks rows of such keys, on either side; they are joined like rows of any table. None
    says that there are none.
    """
    if hot is None:
        return join_faturas_pagamentos(faturas, pagamentos)
    rest, apart = apart_from_hot(hot, faturas, pagamentos)
    return join_faturas_pagamentos(*rest).unionByName(join_faturas_pagamentos(*apart))
