"""The archives that the registered queries share."""

import datetime as dt

from gridloom.plans import stores


def test_events_are_dealt_out_once_and_the_third_archive_waits_for_who_asks(spark, small, monkeypatch):
    wrote, built = [], []
    monkeypatch.setattr(stores.raw, "write_days", lambda s, config, cells: (wrote.append(config.download), [dt.date(2024, 1, 1), dt.date(2024, 1, 3)])[1])
    monkeypatch.setattr(stores.archive, "build", lambda s, config, stop_after=None: built.append((config.suffix, stop_after)))
    made = stores.build(spark, small)
    assert len(wrote) == 1 and built == [("spatial", 1), ("spatial", None), ("temporal", 1), ("temporal", None)]
    assert made.last == dt.date(2024, 1, 3) and made.config.expected_missing_times == ("2024-01-02",)
