from __future__ import annotations

import pytest

from pathquality.sources import inventory as inv
from pathquality.sources import schemas

from .network import INVENTORY_ROWS, inventory_tables


def changed(table, **fields):
    return {table: [{**INVENTORY_ROWS[table][0], **fields}, *INVENTORY_ROWS[table][1:]]}


def test_clean_inventory_has_no_violation(spark):
    assert inv.violations(inventory_tables(spark)).collect() == []


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        (changed("pops", backbone_ms=0), "backbone_ms > 0"),
        (changed("branches", size="huge"), "size"),
        (changed("circuits", role="spare"), "role"),
        (changed("circuits", bandwidth_mbps=0), "bandwidth_mbps > 0"),
        (changed("apps", criticality="vital"), "criticality"),
        (changed("apps", hosted="moon"), "hosted"),
        (changed("sla_targets", response_bad_ms=200), "response bad > good"),
        (changed("sla_targets", rtt_bad_ms=1), "rtt bad > good"),
        (changed("sla_targets", retrans_bad_pct=None), "required retrans_bad_pct"),
        (changed("circuits", tunnel_id=12), "unique tunnel_id"),
        (changed("circuits", role="backup"), "unique branch_id,role"),
        (changed("circuits", provider="ZZZ"), "provider in providers.code"),
        (changed("branches", backup_circuit_id="none"), "backup_circuit_id in circuits.circuit_id"),
        (changed("devices", branch_id="BR-9"), "branch_id in branches.branch_id"),
        (changed("sla_targets", app="none"), "app in apps.name"),
    ],
)
def test_each_rule_is_reported(spark, change, rule):
    from decimal import Decimal

    for rows in change.values():
        rows[0].update({k: Decimal(v) for k, v in rows[0].items()
                        if k == "backbone_ms" and isinstance(v, int)})
    found = {r["rule"] for r in inv.violations(inventory_tables(spark, **change)).collect()}
    assert rule in found


def test_views(spark):
    t = inventory_tables(spark)
    look = inv.lookups(t)
    assert [r["device_id"] for r in look.devices.collect()] == ["ATM-1"]  # no guests
    assert {(r["prefix"], r["segment"]) for r in look.prefixes.collect()} == {
        ("10.1.0.0/24", "lan"), ("10.1.128.0/24", "guest")}
    b = look.branches.first()
    assert (b["payment_switch_id"], b["primary_provider"], b["primary_circuit_id"]) == (
        "BR-1-SW1", "AAA", "CKT-11")
    apps = {r["name"]: (r["response_good_ms"], r["rtt_bad_ms"]) for r in look.apps.collect()}
    assert apps == {"pay": (200.0, 80.0), "mail": (300.0, 100.0)}
    assert {r["provider_name"] for r in look.circuits.collect()} == {"Alpha", "Beta"}
    assert inv.branch_switches(t).count() == 2


def test_csv_round_trip_and_versions(spark, tmp_path):
    folder = tmp_path / "csv"
    for name, df in inventory_tables(spark).items():
        df.coalesce(1).write.csv(str(folder / f"{name}.csv"), header=True)
    tables = inv.read_csv(spark, str(folder))
    root = str(tmp_path / "inventory")
    counts = inv.publish(spark, tables, root, "0001")
    assert counts == {t: len(rows) for t, rows in INVENTORY_ROWS.items()}
    inv.publish(spark, tables, root, "0002")
    now = inv.current(spark, root)
    assert set(now) == set(schemas.INVENTORY) and now["devices"].count() == 2
    inv.drop_version(spark, root, "0001")
    assert inv.current(spark, root)["apps"].count() == 2


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="sla_targets.csv"):
        inv.read_csv(spark, str(tmp_path))


def test_bad_value_fails_the_load(spark, tmp_path):
    for name, df in inventory_tables(spark).items():
        df.coalesce(1).write.csv(str(tmp_path / f"{name}.csv"), header=True)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "sla_targets.csv").write_text(
        "app,response_good_ms,response_bad_ms,rtt_good_ms,rtt_bad_ms,retrans_good_pct,retrans_bad_pct\n"
        "pay,fast,1,1,1,1,1\n")
    tables = inv.read_csv(spark, str(tmp_path), str(tmp_path / "bad"))
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        tables["sla_targets"].collect()


def test_broken_inventory_is_not_published(spark, tmp_path):
    tables = inventory_tables(spark, **changed("branches", size="huge"))
    with pytest.raises(ValueError, match="size branches BR-1"):
        inv.publish(spark, tables, str(tmp_path / "i"), "0001")
    assert not (tmp_path / "i").exists()
