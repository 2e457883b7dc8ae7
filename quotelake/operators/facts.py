"""Building, comparing and slicing the quote fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake import schemas as S
from quotelake.functions.calendar import stamp
from quotelake.operators.bounded import broadcast_if, fits
from quotelake.operators.dedup import first_wins, last_wins
from quotelake.operators.dims import with_keys
from quotelake.operators.keys import fact_id
from quotelake.operators.numbering import numbered
from quotelake.session import staged

PAGE_ROWS = 10_000


def to_facts(keyed: DataFrame) -> DataFrame:
    """Fact columns of quotes that carry their keys."""
    return keyed.selectExpr(
        f"{fact_id(*S.FACT_KEY)} AS id",
        *S.FACT_KEY,
        "open AS open_price",
        "high AS high_price",
        "low AS low_price",
        "close AS close_price",
        "volume",
        "loaded_at",
    )


def first_facts(keyed: DataFrame, order: Sequence[str] = S.BATCH_ORDER) -> DataFrame:
    """One fact per key: the first quote of the batch."""
    return to_facts(first_wins(keyed, S.FACT_KEY, order))


def last_facts(keyed: DataFrame, order: Sequence[str] = S.BATCH_ORDER) -> DataFrame:
    """One fact per key: the quote loaded last."""
    return to_facts(last_wins(keyed, S.FACT_KEY, "loaded_at", order))


def _stored_keys(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """The stored keys that the batch has as well. A batch of checked size goes to the stored
    facts, which are then scanned where they lie and never exchanged."""
    keys = incoming.select(*S.FACT_KEY)
    return stored.select(*S.FACT_KEY).join(broadcast_if(fits(keys), keys), list(S.FACT_KEY), "left_semi")


def only_new(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming facts whose key is not stored."""
    return incoming.join(_stored_keys(incoming, stored), list(S.FACT_KEY), "left_anti")


def already_stored(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming facts whose key is stored."""
    return incoming.join(_stored_keys(incoming, stored), list(S.FACT_KEY), "left_semi")


def facts_to_add(
    quotes: DataFrame,
    assets: DataFrame,
    sources: DataFrame,
    stored: DataFrame,
    order: Sequence[str] = S.BATCH_ORDER,
    now: dt.datetime | None = None,
) -> DataFrame:
    """The facts a batch adds: first quote per key, unless the key is stored already. The
    batch's facts are written once; the comparison with the stored ones reads them twice and
    takes their number from the files."""
    facts = staged(first_facts(with_keys(quotes, assets, sources), order), "batch-facts")
    columns = [name for name in S.FACT_QUOTES.fieldNames() if name != "loaded_at"]
    return only_new(facts, stored).selectExpr(*columns, f"{stamp(now)} AS loaded_at")


def first_quotes(quotes: DataFrame, order: Sequence[str] = S.BATCH_ORDER) -> DataFrame:
    """The first quote of the batch for each ticker, date and source, before keys are known."""
    return first_wins(quotes, ["ticker", "date", "source"], order)


def added(keyed: DataFrame, stored: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """The facts of stored quotes with keys, one per key, whose key is not among ``stored``."""
    columns = [name for name in S.FACT_QUOTES.fieldNames() if name != "loaded_at"]
    return to_facts(only_new(keyed, stored)).selectExpr(*columns, f"{stamp(now)} AS loaded_at")


def fact_pages(facts: DataFrame, rows: int = PAGE_ROWS) -> DataFrame:
    """All facts with the number of their page in id order, from 0: pages of exactly ``rows``
    facts but the last. One exchange, and no task that sees more than its partition."""
    return numbered(facts, [F.asc("id")], "_n").selectExpr("*", f"_n div {int(rows)} AS page").drop("_n")


def replace_facts(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored and incoming facts where the one loaded last wins, the incoming one on a tie."""
    both = stored.selectExpr("*", "0 AS _batch").unionByName(incoming.selectExpr("*", "1 AS _batch"))
    return last_wins(both, S.FACT_KEY, "loaded_at", ["_batch"]).drop("_batch")


def facts_after(facts: DataFrame, last_id: int) -> DataFrame:
    """Facts with an id above ``last_id``: the slice a page scan has not seen."""
    return facts.where(f"id > {int(last_id)}")


def fact_page(facts: DataFrame, last_id: int, rows: int = PAGE_ROWS) -> DataFrame:
    """The next ``rows`` facts in id order."""
    return facts_after(facts, last_id).orderBy("id").limit(rows)
