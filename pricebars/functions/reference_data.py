"""Lookup tables whose content decides the results."""

# symbol -> (company name, sector)
DEFAULT_PROFILES = {
    "AAPL": ("Apple Inc", "Technology"),
    "MSFT": ("Microsoft Corp", "Technology"),
    "NVDA": ("NVIDIA Corp", "Technology"),
    "AMZN": ("Amazon.com Inc", "Consumer Cyclical"),
    "GOOGL": ("Alphabet Inc", "Communication Services"),
    "META": ("Meta Platforms Inc", "Communication Services"),
    "TSLA": ("Tesla Inc", "Consumer Cyclical"),
    "JPM": ("JPMorgan Chase & Co", "Financial Services"),
    "BAC": ("Bank of America Corp", "Financial Services"),
    "V": ("Visa Inc", "Financial Services"),
    "JNJ": ("Johnson & Johnson", "Healthcare"),
    "UNH": ("UnitedHealth Group Inc", "Healthcare"),
    "XOM": ("Exxon Mobil Corp", "Energy"),
}

# code -> canonical country name
CANONICAL_NAMES = {
    "AUS": "Australia",
    "AUT": "Austria",
    "COD": "Democratic Republic of Congo",
    "COG": "Republic of Congo",
    "CON": "Republic of Congo",
    "CPV": "Cabo Verde",
    "CZE": "Czechia",
    "EGY": "Egypt",
    "GMB": "Gambia",
    "GMY": "Germany",
    "HKG": "Hong Kong SAR, China",
    "IRN": "Iran",
    "IVO": "Côte d'Ivoire",
    "CIV": "Côte d'Ivoire",
    "KGZ": "Kyrgyzstan",
    "KOR": "South Korea",
    "PRK": "North Korea",
    "LAO": "Laos",
    "MAC": "Macao SAR, China",
    "MKD": "North Macedonia",
    "PSE": "Palestine",
    "RUS": "Russia",
    "SDN": "Sudan",
    "SLV": "El Salvador",
    "SVN": "Slovenia",
    "SOM": "Somalia",
    "SVK": "Slovakia",
    "SWZ": "Eswatini",
    "CHE": "Switzerland",
    "SYR": "Syria",
    "TLS": "Timor-Leste",
    "TUR": "Turkiye",
    "VEN": "Venezuela",
    "VNM": "Vietnam",
    "YEM": "Yemen",
    "YGS": "Yugoslavia",
    "BHS": "Bahamas",
    "BOL": "Bolivia",
    "BRN": "Brunei",
    "KYR": "Kyrgyzstan",
    "SRB": "Serbia",
}

FALLBACK_CATEGORY = "Other"     # bars whose symbol has no sector
PROFILE_CATEGORY = "Equity"     # profiles that name neither industry nor exchange

# Back-cast of history from one quote, per timeframe:
# periods back, growth per unit of (seed % 9 - 4), open ratio = a + (seed % 5) * b, high and low ratios
BACKCAST = {
    #         periods  step   a     b      high   low
    "day":   (90,      0.001, 0.99, 0.004, 1.008, 0.992),
    "week":  (104,     0.005, 0.98, 0.008, 1.018, 0.982),
    "month": (36,      0.02,  0.97, 0.012, 1.03,  0.97),
    "year":  (None,    0.06,  0.96, 0.016, 1.045, 0.955),   # periods = history years
}
BACKCAST_FLOOR = 0.01
