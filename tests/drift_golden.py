"""Published numbers of the drift sample."""


def golden_counts():
    """Published value counts of the drift sample: value -> (reference, current)."""
    return {
        "Age": {27: (50, 12), 28: (55, 16), 29: (55, 15), 30: (194, 42), 31: (85, 18), 33: (20, 9), 34: (82, 25),
                35: (42, 10), 36: (56, 11), 37: (99, 27), 38: (25, 6)},
        "FrequentFlyer": {0: (532, 136), 1: (231, 55)},
        "AnnualIncomeClass": {0: (311, 75), 1: (324, 85), 2: (128, 31)},
        "ServicesOpted": {1: (324, 80), 2: (143, 33), 3: (94, 30), 4: (92, 25), 5: (57, 12), 6: (53, 11)},
        "AccountSyncedToSocialMedia": {0: (470, 124), 1: (293, 67)},
        "BookedHotelOrNot": {0: (295, 83), 1: (468, 108)},
    }
