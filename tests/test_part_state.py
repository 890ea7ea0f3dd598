import os
import shutil

import pytest

from paygrain.operators import part_state, quality


@pytest.fixture
def folder(tmp_path, payments):
    """Write payments as one part file of a folder."""

    def write(name: str, *rows: dict, drop: tuple = ()):
        (tmp_path / "fact").mkdir(exist_ok=True)
        made = tmp_path / f"made-{len(os.listdir(tmp_path))}"
        payments(*rows).drop(*drop).coalesce(1).write.parquet(str(made))
        (file,) = made.glob("*.parquet")
        shutil.copy(file, tmp_path / "fact" / name)
        return str(tmp_path / "fact")

    return write


def plain(checks) -> list[tuple]:
    return sorted(tuple(r) for r in checks.collect())


def failed(checks) -> dict[str, int]:
    return {r.check: r.violations for r in checks.collect() if not r.passed and r.severity == "critical"}


def ids(first: int, last: int, **changes) -> list[dict]:
    return [{"number": i, **changes} for i in range(first, last + 1)]


def test_a_later_run_reads_new_files_only(spark, folder, dimensions, tmp_path):
    for k in range(5):
        where = folder(f"part {k}+%41.parquet", *ids(10 * k + 1, 10 * k + 10, transaction_status="approved" if k else "declined"))
    state = str(tmp_path / "state")
    part_state.validate_parts(spark, where, state, dimensions, 50).collect()
    # Old files cannot be read any more, but are of the same size and time.
    for name in os.listdir(where):
        path = os.path.join(where, name)
        times = os.stat(path)
        with open(path, "r+b") as file:
            file.write(b"x" * times.st_size)
        os.utime(path, ns=(times.st_atime_ns, times.st_mtime_ns))
    folder("part 5+%41.parquet", *ids(45, 60, customer_id="C9"))
    found = part_state.validate_parts(spark, where, state, dimensions, 66)
    bad = failed(found)
    assert bad.pop("part 0+%41.parquet: decline reason logic") == 10
    assert bad.pop("part 5+%41.parquet: customer foreign key") == 16
    assert bad.pop("part 5+%41.parquet: transaction_id sequence does not overlap prior part") == 1
    assert bad == {"fact_transactions: global transaction_id range": 1}
    assert spark.read.parquet(state).count() == 6


def test_equals_a_run_over_all_files(spark, folder, dimensions, tmp_path):
    reports = []
    for k in range(4):
        where = folder(f"p{k}.parquet", *ids(10 * k + 1, 10 * k + 9 + k, is_cross_border=k == 2, transaction_amount_usd=0.5 + k))
        reports.append(plain(part_state.validate_parts(spark, where, str(tmp_path / "state"), dimensions, 42)))
    assert reports[-1] == plain(part_state.validate_parts(spark, where, str(tmp_path / "anew"), dimensions, 42))
    assert len({len(r) for r in reports}) == 4
    both = [part_state.totals(part_state.seen_parts(spark, where, str(tmp_path / s), dimensions)) for s in ("state", "anew")]
    assert both[0].collect() == both[1].collect()
    assert both[0].first().rows == 42 and both[0].first().high == 42


def test_rewritten_and_removed_files_and_changed_dimensions(spark, folder, dimensions, tmp_path):
    state = str(tmp_path / "state")
    where = folder("a.parquet", *ids(1, 5, transaction_amount=-1.0))
    folder("b.parquet", *ids(6, 9))
    assert failed(part_state.validate_parts(spark, where, state, dimensions)) == {"a.parquet: positive transaction amounts": 5}
    folder("a.parquet", *ids(1, 4))
    assert failed(part_state.validate_parts(spark, where, state, dimensions)) == {}
    no_customers = {**dimensions, "dim_customer": dimensions["dim_customer"].limit(0)}
    found = failed(part_state.validate_parts(spark, where, state, no_customers))
    assert found == {"a.parquet: customer foreign key": 4, "b.parquet: customer foreign key": 4}
    assert failed(part_state.validate_parts(spark, where, state, dimensions)) == {}
    os.remove(os.path.join(where, "a.parquet"))
    assert part_state.totals(part_state.seen_parts(spark, where, state, dimensions)).first().rows == 4


def test_empty_files_and_missing_columns(spark, folder, dimensions, tmp_path):
    state = str(tmp_path / "state")
    where = folder("a.parquet")
    found = part_state.validate_parts(spark, where, state, dimensions, 0)
    assert not [r for r in found.collect() if r.check.startswith("a.parquet")]
    assert part_state.seen_parts(spark, where, state, dimensions).count() == 1
    folder("b.parquet", *ids(1, 3), drop=("channel",))
    found = part_state.validate_parts(spark, where, state, dimensions, 3)
    assert failed(found) == {"b.parquet: required fields non-null": 3}
    assert spark.read.parquet(state).count() == 2
    with pytest.raises(ValueError, match="no part files"):
        part_state.validate_parts(spark, where, str(tmp_path / "other"), dimensions, pattern="*.none")


def test_repeated_ids_nulls_and_no_dimensions(spark, payments):
    fact = payments(*ids(1, 2), {"number": 2}, {"number": 3, "customer_id": None, "transaction_id": None})
    summary = part_state.part_summaries(fact.selectExpr("*", "'p' AS part"), {})
    found = failed(part_state.report(summary, {}))
    assert found == {"p: required fields non-null": 2, "p: transaction_id unique within part": 1}
    assert quality.gate(part_state.report(summary, {})).first().status == "FAIL"
