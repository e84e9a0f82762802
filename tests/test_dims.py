import datetime as dt

from farebox.operators import dims
from farebox.sources.seeds import read_seed_csv


def test_dim_date_iso_week_and_names(spark):
    d = dims.dim_date(spark, dt.date(2024, 1, 1), dt.date(2025, 1, 1))
    assert d.count() == 366 + 1   # and the unknown member
    r = d.where("date_day = date'2024-12-30'").first()
    assert (r.date_key, r.year, r.week_of_year, r.day_of_week, r.day_name, r.month_name, r.quarter,
            r.is_weekend) == (20241230, 2024, 1, 1, "Monday", "December", 4, False)
    sun = d.where("date_day = date'2024-01-07'").first()
    assert (sun.day_of_week, sun.is_weekend) == (7, True)


def test_dim_date_empty_range(spark):
    empty = dims.dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 1)).collect()
    assert [(r.date_key, r.date_day, r.month_name, r.is_weekend) for r in empty] == [(-1, None, "Unknown", False)]


# A few rows of the zone seed.
def test_dim_location_defaults_and_unknown(spark, tmp_path):
    p = tmp_path / "seed.csv"
    with open(p, "w") as fh:
        fh.write('"LocationID","Borough","Zone","service_zone"\n'
                 '1,"EWR","Newark Airport","EWR"\n'
                 '264,"Unknown","N/A","N/A"\n'
                 '265,,,\n'
                 '56,"Queens","Corona","Boro Zone"\n57,"Queens","Corona","Boro Zone"\n')
    seed = read_seed_csv(spark, f"file:{p}")
    d = {r.location_id: r for r in dims.dim_location(seed).collect()}
    assert d[1].is_airport is True and d[1].zone_full_name == "Newark Airport, EWR"
    assert d[264].zone_name == "N/A" and d[264].is_airport is False
    assert (d[265].zone_name, d[265].borough, d[265].zone_full_name) == ("Unknown", "Unknown", "Unknown, Unknown")
    assert (d[-1].zone_name, d[-1].is_airport) == ("Unknown", False)
    assert d[56].zone_name == d[57].zone_name == "Corona"


def test_dim_payment_type(spark):
    d = {r.payment_type_id: r for r in dims.dim_payment_type(spark).collect()}
    assert len(d) == 8
    assert d[1].tips_are_reliable is True and d[2].tips_are_reliable is False
    assert d[-1].payment_type_name == "Unknown"
