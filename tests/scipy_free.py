"""D'Agostino and Pearson's statistic in plain Python, from the published formulas."""

import math


def k2(values):
    n = len(values)
    mean = sum(values) / n
    m2, m3, m4 = (sum((x - mean) ** k for x in values) / n for k in (2, 3, 4))
    g1, g2 = m3 / m2**1.5, m4 / m2**2
    y = g1 * math.sqrt((n + 1) * (n + 3) / (6 * (n - 2))) or 1.0
    beta = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = math.sqrt(2 * (beta - 1)) - 1
    z1 = math.asinh(y / math.sqrt(2 / (w2 - 1))) / math.sqrt(math.log(math.sqrt(w2)))
    expected, variance = 3 * (n - 1) / (n + 1), 24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (g2 - expected) / math.sqrt(variance)
    root = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / root * (2 / root + math.sqrt(1 + 4 / root**2))
    d = 1 + x * math.sqrt(2 / (a - 4))
    z2 = (1 - 2 / (9 * a) - math.copysign((abs((1 - 2 / a) / d)) ** (1 / 3), d)) / math.sqrt(2 / (9 * a))
    return z1 * z1 + z2 * z2
