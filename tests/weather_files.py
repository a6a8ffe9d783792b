"""Small bulletins and dimensions, written as files."""

import os

COMPASS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]
HEADER = '"Daily observations, temperatures in °C"\r\n\r\n,"Date","Minimum"\r\n'


def line(day, rain="0", gust="N", speed9="10", dir9="E", speed3="20", mintemp="5.0", hum="60"):
    """One data line; the first field, a comment, is always empty."""
    fields = [
        "", day, mintemp, "21.5", rain, "", "", gust, "40", "12:00", "10.1", hum, "3", dir9, speed9, "1013.2",
        "18.4", "40", "", "W", speed3, "1010.0",
    ]
    return ",".join(fields)


def month(period, seed, days=28):
    """A month of plausible lines: rain follows low pressure of the day before."""
    year, mon = period[:4], period[4:]
    out = []
    for d in range(1, days + 1):
        n = (d * 7 + seed * 13) % 10
        rain = "" if n == 9 else "5.2" if (d + seed) % 4 == 0 else "1.0" if n == 1 else "0.2"
        speed9 = "Calm" if n == 3 else str(5 + n)
        out.append(
            line(
                f"{year}-{mon}-{d}", rain, "" if n == 2 else COMPASS[(d + seed) % 8], speed9,
                " " if n == 3 else COMPASS[n % 8], str(10 + d % 7), f"{5 + (d % 9) / 2}", str(95 if (d + seed) % 4 == 3 else 40 + n),
            )
        )
    return out


def write_digest_files(folder, months):
    """{(data_id, period): lines} as digest files."""
    os.makedirs(folder, exist_ok=True)
    for (data_id, period), lines in months.items():
        with open(os.path.join(folder, f"{data_id}.{period}.csv"), "w", encoding="utf-8", newline="") as f:
            f.write("\n".join(lines) + "\n")


def write_bulletins(folder, months):
    """The same as raw Windows-1252 bulletins."""
    os.makedirs(folder, exist_ok=True)
    for (data_id, period), lines in months.items():
        with open(os.path.join(folder, f"{data_id}.{period}.csv"), "wb") as f:
            f.write((HEADER + "\r\n".join(lines) + "\r\n").encode("cp1252"))


def write_dims(folder, names):
    """Stations and data ids for {data_id: location}; returns both paths."""
    os.makedirs(folder, exist_ok=True)
    stations, ids = os.path.join(folder, "stations.csv"), os.path.join(folder, "ids.csv")
    with open(stations, "w", encoding="utf-8") as f:
        f.write("Code,Location,Climat\n" + "".join(f"00{i},{n},Tempéré\n" for i, n in enumerate(names.values())))
    with open(ids, "w", encoding="utf-8") as f:
        f.write("station_id,data_id\n" + "".join(f"00{i},{d}\n" for i, d in enumerate(names)))
    return stations, ids
