import os

from small import shipment, star

from tradeledger.plans import roundtrip
from tradeledger.sources import sinks


def test_reports_write_the_files_they_read(spark, tmp_path, monkeypatch):
    """Either half of the export alone, and each report only its own; the whole export still writes both."""
    s = star(spark, shipments=[shipment("1996-05-05"), shipment("1997-05-04", gross=70)])
    sinks.write_csv_by_year(s.shipments, str(tmp_path / "whole"))
    assert sorted(os.listdir(tmp_path / "whole")) == ["all", "by_year"]
    monkeypatch.setattr(roundtrip, "_folder", lambda star, name: str(tmp_path / name))
    combined = roundtrip.read_shipments(s).collect()
    yearly = roundtrip.write_csv_by_year(s).collect()
    assert os.listdir(tmp_path / "shipments") == ["all"]
    assert os.listdir(tmp_path / "shipments_by_year") == ["by_year"]
    assert sorted(combined) == sorted(yearly) and len(combined) == 2
