"""Published extracts used as regression constants."""

from datetime import date

# The seven published extracts, one row per tuple in their column order.
KPIS = [(50000, 42276, 42276, 35542, 35536, 891772, "49766763.58", "88058.53")]
CHANNELS = [
    ("referral", 8052, 6331, 78.63, "184231.98", 22.88, 29.10, 1591.61, 2.85),
    ("organic", 13922, 10325, 74.16, "27910.62", 2.00, 2.70, 1461.95, 2.58),
    ("paid_search", 11924, 8394, 70.40, "452084.37", 37.91, 53.86, 1383.19, 2.46),
    ("affiliate", 6003, 4026, 67.07, "242802.14", 40.45, 60.31, 1294.65, 2.26),
    ("paid_social", 10099, 6466, 64.03, "411094.94", 40.71, 63.58, 1202.12, 2.10),
]
COHORTS = [
    (date(2026, 1, 1), 5174, 3966, 76.65, 3992, 77.16),
    (date(2026, 2, 1), 5564, 4296, 77.21, 4316, 77.57),
    (date(2026, 3, 1), 5959, 4668, 78.34, 4645, 77.95),
    (date(2026, 4, 1), 5870, 4578, 77.99, 4580, 78.02),
    (date(2026, 5, 1), 6043, 4717, 78.06, 4756, 78.70),
]
EXPERIMENT = [
    ("bonus_10", 25081, 18340, 73.12, "183400.00", 2.48, -7.52),
    ("control", 24919, 17202, 69.03, "0.00", 2.47, 2.47),
]
SEGMENTS = [
    ("FX user", 30578, 25.98, 1507.97, 2.73),
    ("Non-FX user", 4964, 13.57, 736.52, 0.95),
]
FX_RETENTION = [("FX user", 30169, 24218, 80.27), ("Non-FX user", 4731, 2929, 61.91)]
ECONOMICS = [
    ("card_payment", 545143, "17729252.08", "115239.34", "37504.56", "77734.78", 0.1426),
    ("fx_exchange", 91240, "8811694.28", "35247.32", "2737.20", "32510.12", 0.3563),
    ("cash_in", 35542, "2984376.13", "0.00", "710.84", "-710.84", -0.0200),
    ("bank_transfer", 131807, "17137950.56", "3692.50", "5272.28", "-1579.78", -0.0120),
    ("cash_withdrawal", 57945, "3103490.53", "385.00", "20280.75", "-19895.75", -0.3434),
]

ALL = {
    "kpis": KPIS,
    "channel_performance": CHANNELS,
    "retention_cohorts": COHORTS,
    "experiment_performance": EXPERIMENT,
    "fx_customer_segments": SEGMENTS,
    "fx_retention": FX_RETENTION,
    "transaction_economics": ECONOMICS,
}
