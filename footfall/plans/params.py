"""Parameters the registered queries run with."""

START_DATE, END_DATE = "2024-01-10", "2024-01-20"
RUN_DATE = "2024-01-15"
RANGE_MS = (1705269600000, 1705287600000)  # 2024-01-14 22:00 to 2024-01-15 03:00 UTC
SCAN_DAYS = ("2024-01-14", "2024-01-16")
SAMPLE_TOTAL = 3000  # sessions, of all days
PAGE_FLOW = [1, 2, 3, 4]
BLACKLIST_THRESHOLD = 2
OWN_HOSTS = ["shop.example.com"]
INBOUND_PATTERNS = [(3, "www.search-a.example"), (4, "m.search-b.example")]
IP_RANGES = [
    ("10.0.0.0", "10.127.255.255", "net-a"),
    ("10.128.0.0", "11.255.255.255", "net-b"),
    ("12.0.0.0", "13.255.255.255", "net-c"),
]
AREA_LEVELS = {
    "A Level": ["AFRICA", "AMERICA"],
    "B Level": ["ASIA", "EUROPE"],
    "C Level": ["MIDDLE EAST"],
}
TASK = {
    "start_age": 20,
    "end_age": 60,
    "professionals": ["BUILDING", "MACHINERY", "HOUSEHOLD"],
    "cities": [f"city{i}" for i in range(0, 20)],
    "sex": "male",
    "keywords": ["kw1", "kw2", "kw3", "kw4", "kw5"],
    "category_ids": [str(i) for i in range(0, 12)],
}
