"""Fixed values of the data model: names, ids, codes and dimension rows."""

# Country name in the case reports -> warehouse id.
COUNTRY_IDS = {"Argentina": 1, "Chile": 2, "Ecuador": 3, "Spain": 4, "Mexico": 5}

# Country code -> warehouse id. Chile is CH in the case series
# and CL in the tweets; both are accepted everywhere.
CODE_IDS = {"AR": 1, "CH": 2, "CL": 2, "EC": 3, "ES": 4, "MX": 5}

# English country name -> name shown in the demand table.
LOCAL_NAMES = {"Spain": "Espanha", "Mexico": "México", "Ecuador": "Equador"}

# Fixed values: (id, pais)
COUNTRIES = [(1, "Argentina"), (2, "Chile"), (3, "Equador"), (4, "Espanha"), (5, "México")]

# Fixed values: (paises_id, ano, periodo_referencia, nota, classificacao)
HAPPINESS = [
    (1, 2019, "2016-2018", 6086.0, 47),
    (1, 2020, "2017-2019", 5975.0, 55),
    (1, 2021, "2018-2020", 5929.0, 57),
    (1, 2022, "2019-2021", 5967.0, 57),
    (2, 2019, "2016-2018", 6444.0, 26),
    (2, 2020, "2017-2019", 6228.0, 39),
    (2, 2021, "2018-2020", 6172.0, 43),
    (2, 2022, "2019-2021", 6172.0, 44),
    (3, 2019, "2016-2018", 6028.0, 50),
    (3, 2020, "2017-2019", 5925.0, 58),
    (3, 2021, "2018-2020", 5764.0, 66),
    (3, 2022, "2019-2021", 5533.0, 76),
    (4, 2019, "2016-2018", 6354.0, 30),
    (4, 2020, "2017-2019", 6401.0, 28),
    (4, 2021, "2018-2020", 6491.0, 27),
    (4, 2022, "2019-2021", 6476.0, 29),
    (5, 2019, "2016-2018", 6595.0, 23),
    (5, 2020, "2017-2019", 6465.0, 24),
    (5, 2021, "2018-2020", 6317.0, 36),
    (5, 2022, "2019-2021", 6476.0, 46),
]

# Fixed values: (paises_id, data_inicio, data_fim, total_dias)
LOCKDOWNS = [
    (1, "2020-03-19", "2020-05-10", 52),
    (3, "2020-03-16", "2020-03-31", 15),
    (4, "2020-03-14", "2020-05-09", 56),
    (5, "2020-03-23", "2020-06-01", 70),
]

# First and last day of the calendar dimension.
CALENDAR_START, CALENDAR_END = "2018-01-01", "2023-12-31"

# Fact table -> (warehouse column, source column, type).
FACTS = {
    "COVID_JHONS_HOPKINS": [
        ("PAISES_ID", "country", "int"),
        ("CALENDARIO_data", "date", "date"),
        ("confirmados", "Confirmed", "int"),
        ("mortes", "Deaths", "int"),
        ("recuperados", "Recovered", "int"),
        ("novos_casos", "New_Confirmed", "int"),
        ("novas_mortes", "New_Deaths", "int"),
        ("ativos", "Active", "int"),
    ],
    "SENTIMENTOS": [
        ("PAISES_ID", "country", "int"),
        ("CALENDARIO_data", "date", "date"),
        ("tweet", "texto", "string"),
        ("negativo", "neg", "double"),
        ("positivo", "pos", "double"),
        ("neutro", "neu", "double"),
        ("composto", "compound", "double"),
    ],
    "DEMANDA_ENERGIA": [
        ("PAISES_ID", "country", "int"),
        ("CALENDARIO_data", "date", "date"),
        ("demanda_TWh", "value", "double"),
    ],
    "PREVISAO_CASOS": [
        ("PAISES_ID", "country", "int"),
        ("CALENDARIO_data", "forecast_date", "date"),
        ("data_prevista", "forecasted_date", "date"),
        ("casos_previstos", "forecast", "double"),
    ],
    "COVID_WORLDOMETER": [
        ("PAISES_ID", "Country", "int"),
        ("CALENDARIO_data", "Date", "date"),
        ("populacao", "Population", "int"),
        ("total_casos", "TotalCases", "int"),
        ("novos_casos", "NewCases", "int"),
        ("total_mortes", "TotalDeaths", "int"),
        ("novas_mortes", "NewDeaths", "int"),
        ("total_recuperados", "TotalRecovered", "int"),
        ("novos_recuperados", "NewRecovered", "int"),
        ("casos_ativos", "ActiveCases", "int"),
        ("casos_criticos", "Serious,Critical", "int"),
        ("total_casos_1Mpop", "Tot Cases/1M pop", "double"),
        ("total_mortes_1Mpop", "Deaths/1M pop", "double"),
        ("total_testes", "TotalTests", "int"),
        ("total_testes_1Mpop", "Tests/1M pop", "double"),
        ("mortalidade", "Mortality", "double"),
    ],
}

# Columns that name a fact row, used for its surrogate ID.
FACT_KEYS = {
    "COVID_JHONS_HOPKINS": ["PAISES_ID", "CALENDARIO_data"],
    "SENTIMENTOS": ["PAISES_ID", "CALENDARIO_data", "tweet"],
    "DEMANDA_ENERGIA": ["PAISES_ID", "CALENDARIO_data"],
    "PREVISAO_CASOS": ["PAISES_ID", "CALENDARIO_data", "data_prevista"],
    "COVID_WORLDOMETER": ["PAISES_ID", "CALENDARIO_data"],
}

# Partition grain of a fact: days where a day holds many rows (texts), years
# where it holds one row per country.
FACT_GRAINS = {
    "COVID_JHONS_HOPKINS": "year", "SENTIMENTOS": "day", "DEMANDA_ENERGIA": "year", "PREVISAO_CASOS": "year",
    "COVID_WORLDOMETER": "year",
}

# Header of the scraped country table, in the order it is kept.
SNAPSHOT_NUMBERS = [
    "Population", "TotalCases", "NewCases", "TotalDeaths", "NewDeaths",
    "TotalRecovered", "NewRecovered", "ActiveCases", "Serious,Critical",
    "Tot Cases/1M pop", "Deaths/1M pop", "TotalTests", "Tests/1M pop",
]
