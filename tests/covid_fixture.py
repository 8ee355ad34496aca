"""Hand-made feeds shaped like the public-health inputs (see test_star.py for the cases)."""

from starmart.schemas import CASE_FEED, COUNTY_FEED, HOSPITALS, STATES_DAILY


def make_feeds(spark):
    case = [(1001.0, "Alabama", "US", 32.5, -86.6)] * 3 + [
        (1001.0, "Alabama", "US", 32.6, -86.6),
        (1003.0, "Alabama", "US", 30.7, -87.7),
        (72.0, "Puerto Rico", "US", 18.2, -66.5),
        (6037.0, "Grand Princess", "US", 37.6, -122.4),
        (None, "Alabama", "US", 1.0, 1.0),
        (6037.0, None, "US", 34.0, -118.2),
        (6001.0, "California", "US", None, -122.0),
        (123456.0, "Nowhere", "US", 1.0, 1.0),
    ]
    county = ([(1001.0, "Autauga")] * 4 + [(1003.0, "Baldwin")] * 2 + [(72.0, "Puerto Rico")]
              + [(6037.0, "Los Angeles")] * 2 + [(123456.0, "Far")] + [(6001.0, "Alameda")])
    hosp = [
        (1001.0, "Alabama", "Autauga", 32.4, -86.5, 'Prattville Baptist, "East"',
         "124 S Memorial Dr, Suite 1", "Prattville", "AL", 36067, "Short Term"),
        (1003.0, "Alabama", "Baldwin", 30.6, -87.9, "Thomas Hospital", "750 Morphy Ave",
         "Fairhope", "AL", 36532, "Short Term"),
        (6037.0, "California", "Los Angeles", 34.1, -118.4, "Cedars", None, None, "CA", None,
         "Critical Access"),
        (None, "Alabama", "X", 1.0, 1.0, "No code", None, None, None, None, None),
        (6001.0, None, "Alameda", 1.0, 1.0, "No state", None, None, None, None, None),
    ]
    def day(fips, date, st, pos, death, hcur):
        r = [fips, date, st, pos, None, None, hcur, None, None, death, None, None, None, int(pos)]
        return tuple(r)

    daily = [
        day(1.0, 20200113, "AL", 10.0, 1.0, 2.0),
        day(1.0, 20200114, "AL", 15.0, 2.0, 3.0),
        day(6.0, 20200113, "CA", 100.0, 7.0, None),
        day(6.0, 20200115, "CA", 120.0, 9.0, 5.0),
        day(72.0, 20200114, "PR", 3.0, 0.0, 1.0),
        day(None, 20200116, "XX", 1.0, 0.0, 1.0),
        day(12.0, 20200112, None, 1.0, 0.0, 1.0),
    ]
    return {
        "case": spark.createDataFrame(case, CASE_FEED),
        "county": spark.createDataFrame(county, COUNTY_FEED),
        "hospitals": spark.createDataFrame(hosp, HOSPITALS),
        "daily": spark.createDataFrame(daily, STATES_DAILY),
    }


