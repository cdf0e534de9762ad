"""Raw events for tests; a module of its own, since each folder of tests has a conftest."""

import pandas as pd

from gustline import contract as K

# --- fixed values: the cells of a usual event, and those in which ten rows differ from it
USUAL = {
    K.KEY: "100", K.NAME: "Acme Power", K.STATE: "TX", K.OWNERSHIP: "Cooperative", K.REGION: "SPP",
    K.COUNTIES: "2.0", K.SAIDI: "100.5", K.SAIFI: "1.2", K.RELIABILITY[2]: "80.0",
    K.RELIABILITY[3]: "90.0", K.RELIABILITY[4]: "1.1", K.RELIABILITY[5]: "75.0",
    K.EVENT_TYPE: "Hail", K.MONTH: "April", K.MAGNITUDE: "1.5", K.DAMAGE[0]: "1000.0",
    K.DAMAGE[1]: "0.0", **dict.fromkeys(K.HARM, "0"), K.EVENT_TIME_TEXT: "01-APR-24 10:40:00",
    "EXTRA_COL": "ignored",
}
DIFFERENT = pd.DataFrame(
    [
        (1, K.KEY, "200"), (1, K.STATE, "CA"), (1, K.EVENT_TYPE, "Wildfire"), (1, "TRE", "Y"),
        (2, K.KEY, "300"), (2, K.STATE, "NY"), (2, K.MAGNITUDE, "NaN"),
        (3, K.KEY, "400"), (3, K.OWNERSHIP, ""), (3, K.REGION, " WECC "),
        (4, K.KEY, "500"), (4, K.SAIDI, "abc"),
        (5, K.STATE, "ZZ"), (6, K.STATE, ""), (7, K.KEY, "600"), (7, K.HARM[0], "-3"),
        (9, K.KEY, "200"), (9, K.STATE, "CA"), (9, K.EVENT_TYPE, "Wildfire"), (9, "TRE", "Y"),
    ],
    columns=["row", "column", "cell"],
)
ACCEPTED, REJECTED, REPEATED = range(5), range(5, 8), range(8, 10)


def usual_events(n: int, **columns) -> pd.DataFrame:
    """``n`` usual events; ``columns`` have values of their own."""
    blank = pd.DataFrame("", index=range(n), columns=[*K.EVENT_CONTRACT, "EXTRA_COL"])
    return blank.assign(**USUAL | columns)


def mixed_events() -> pd.DataFrame:
    """Rows 0 to 4 are accepted, 5 to 7 rejected, 8 and 9 repeat rows 0 and 1."""
    events = usual_events(10)
    for row, column, cell in DIFFERENT.itertuples(index=False):
        events.loc[row, column] = cell
    return events


def as_file(events: pd.DataFrame, path) -> str:
    events.to_csv(path, index=False)
    return str(path)
