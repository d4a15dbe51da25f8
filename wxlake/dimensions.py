"""Small fixed reference tables.

Each is an inline VALUES relation, so Catalyst knows its exact size and picks a
broadcast join by itself; none depends on the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Area code -> main city (Corsica is "20" in the daily files).
AREA_CITY = {
    "01": "Bourg-en-Bresse", "02": "Laon", "03": "Moulins", "04": "Digne-les-Bains",
    "05": "Gap", "06": "Nice", "07": "Privas", "08": "Charleville-Mézières",
    "09": "Foix", "10": "Troyes", "11": "Carcassonne", "12": "Rodez",
    "13": "Marseille", "14": "Caen", "15": "Aurillac", "16": "Angoulême",
    "17": "La Rochelle", "18": "Bourges", "19": "Tulle", "20": "Ajaccio",
    "21": "Dijon", "22": "Saint-Brieuc", "23": "Guéret", "24": "Périgueux",
    "25": "Besançon", "26": "Valence", "27": "Évreux", "28": "Chartres",
    "29": "Quimper", "30": "Nîmes", "31": "Toulouse", "32": "Auch",
    "33": "Bordeaux", "34": "Montpellier", "35": "Rennes", "36": "Châteauroux",
    "37": "Tours", "38": "Grenoble", "39": "Lons-le-Saunier", "40": "Mont-de-Marsan",
    "41": "Blois", "42": "Saint-Étienne", "43": "Le Puy-en-Velay", "44": "Nantes",
    "45": "Orléans", "46": "Cahors", "47": "Agen", "48": "Mende",
    "49": "Angers", "50": "Saint-Lô", "51": "Châlons-en-Champagne", "52": "Chaumont",
    "53": "Laval", "54": "Nancy", "55": "Bar-le-Duc", "56": "Vannes",
    "57": "Metz", "58": "Nevers", "59": "Lille", "60": "Beauvais",
    "61": "Alençon", "62": "Arras", "63": "Clermont-Ferrand", "64": "Pau",
    "65": "Tarbes", "66": "Perpignan", "67": "Strasbourg", "68": "Colmar",
    "69": "Lyon", "70": "Vesoul", "71": "Mâcon", "72": "Le Mans",
    "73": "Chambéry", "74": "Annecy", "75": "Paris", "76": "Rouen",
    "77": "Melun", "78": "Versailles", "79": "Niort", "80": "Amiens",
    "81": "Albi", "82": "Montauban", "83": "Toulon", "84": "Avignon",
    "85": "La Roche-sur-Yon", "86": "Poitiers", "87": "Limoges", "88": "Épinal",
    "89": "Auxerre", "90": "Belfort", "91": "Évry", "92": "Nanterre",
    "93": "Bobigny", "94": "Créteil", "95": "Pontoise",
}

# The ten featured cities with area code, latitude and longitude.
FEATURED = (
    ("Paris", "75", 48.8566, 2.3522),
    ("Lyon", "69", 45.7640, 4.8357),
    ("Marseille", "13", 43.2965, 5.3698),
    ("Toulouse", "31", 43.6047, 1.4442),
    ("Nice", "06", 43.7102, 7.2620),
    ("Nantes", "44", 47.2184, -1.5536),
    ("Strasbourg", "67", 48.5734, 7.7521),
    ("Bordeaux", "33", 44.8378, -0.5792),
    ("Lille", "59", 50.6292, 3.0573),
    ("Rennes", "35", 48.1173, -1.6778),
)

# Cities of the 30-day chart.
CHART_CITIES = ("Strasbourg", "Lille", "Paris", "Nice")

# Alert phenomenon id -> label.
PHENOMENA = {
    1: "vent_violent", 2: "pluie_inondation", 3: "orages", 4: "inondation",
    5: "neige_verglas", 6: "canicule", 7: "grand_froid", 8: "avalanches",
    9: "vagues_submersion",
}

# Alert color id -> label.
ALERT_COLORS = {1: "vert", 2: "jaune", 3: "orange", 4: "rouge"}

# Alerts split Corsica in two areas that the daily files keep as one.
AREA_ALIAS = {"2A": "20", "2B": "20"}


def _literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, float):
        return f"{value!r}e0"
    return str(value)


def values_sql(rows) -> str:
    """``VALUES`` text of constant rows; the same text works in DuckDB."""
    return "VALUES " + ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)


def constant_frame(spark: SparkSession, rows, names: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM ({values_sql(rows)}) AS t({names})")


def areas(spark: SparkSession) -> DataFrame:
    return constant_frame(spark, AREA_CITY.items(), "dept, city")


def featured(spark: SparkSession) -> DataFrame:
    return constant_frame(spark, FEATURED, "city, dept, lat, lon")
