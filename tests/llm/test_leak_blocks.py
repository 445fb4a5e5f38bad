"""Benchmark items searched in blocks, one index at a time."""

from slotbook.llm import decontaminate
from slotbook.llm.common import on_workers, table


def test_blocks_find_the_same_items(spark, sf_dir):
    on_workers(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark")
    n = items.count()

    def found(block):
        rows = decontaminate.find_leaks(docs, items, rules=decontaminate.LeakRules(block=block)).collect()
        return {(r["doc_id"], x["item_id"]) for r in rows for x in r["leaks"]}, len(rows)

    assert n > 20
    whole = found(2000)
    assert found(-(-n // 3)) == whole and whole[0]
