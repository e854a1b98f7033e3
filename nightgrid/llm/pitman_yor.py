"""Seating in Pitman-Yor restaurants, for arrays of dishes at once.

A restaurant is kept as customers and tables per dish; who sits at which table is summed out,
since predictions need no more.  A dish with one customer has one table.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Up to so many customers of a dish the number of tables is drawn from its exact conditional.
EXACT_CUSTOMERS = 256
#: Dishes of a restaurant are drawn in so many turns, each seeing what the turns before it drew.
TURNS = 4
#: Strengths among which a level's one is drawn.
STRENGTHS = np.array([0.1, 0.3, 1, 3, 10, 30, 100, 300, 1000, 3000, 10000], np.float64)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma of positive numbers, by Stirling's series beyond 8."""
    x = np.asarray(x, np.float64)
    shift = np.log(x)
    for k in range(1, 8):
        shift = shift + np.log(x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


@lru_cache(maxsize=4)
def log_stirling(discount: float, most: int = EXACT_CUSTOMERS) -> np.ndarray:
    """log S(c, t), the weight of all ways to seat c customers at t tables; -inf where there is none."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0.0
    tables = np.arange(1, most + 1)
    for c in range(1, most):
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where(tables <= c, np.log(np.maximum(c - tables * discount, 1e-300)), -np.inf) + out[c, 1:]
        out[c + 1, 1:] = np.logaddexp(out[c, :-1], stay)
    return out


def draw_tables(
    customers: np.ndarray, parent: np.ndarray, others: np.ndarray, discount: float, strength: float, rng: np.random.Generator
) -> np.ndarray:
    """A number of tables for each dish given the tables of the other dishes of its restaurant.

    P(t) is proportional to S(c, t) * parent^t * product over i < t of (strength + discount * (others + i)).
    Customers beyond ``EXACT_CUSTOMERS`` of a dish sit down after those in growing blocks, each
    block seeing the tables of the blocks before it.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    known = log_stirling(round(discount, 6))
    low = 1
    while low < EXACT_CUSTOMERS:
        high = min(2 * low, EXACT_CUSTOMERS)
        last = high == EXACT_CUSTOMERS
        some = np.flatnonzero((customers > low) & ((customers <= high) | last))
        for at in range(0, len(some), 1 << 15):
            rows = some[at : at + (1 << 15)]
            i = np.arange(high)
            new = np.log(parent[rows, None] * (strength + discount * (others[rows, None] + i)))
            weight = known[np.minimum(customers[rows], high), 1 : high + 1] + np.cumsum(new, axis=1)
            tables[rows] = 1 + np.argmax(weight + rng.gumbel(size=weight.shape), axis=1)
        low = high
    more = np.flatnonzero(customers > EXACT_CUSTOMERS)
    seated = np.full(len(more), EXACT_CUSTOMERS, np.int64)
    while len(more):
        block = np.minimum(customers[more] - seated, np.maximum(1, seated // 16))
        opens = parent[more] * (strength + discount * (others[more] + tables[more]))
        chance = opens / (opens + np.maximum(seated - discount * tables[more], 1e-9))
        tables[more] += rng.binomial(block, np.clip(chance, 0.0, 1.0))
        seated += block
        going = seated < customers[more]
        more, seated = more[going], seated[going]
    return tables


def draw_restaurants(
    restaurant: np.ndarray, customers: np.ndarray, tables: np.ndarray, all_tables: np.ndarray, parent: np.ndarray,
    discount: float, strength: float, rng: np.random.Generator,
) -> tuple[np.ndarray, np.ndarray]:
    """(tables per dish, tables per restaurant) after one sweep.  ``restaurant`` is each dish's index into ``all_tables``."""
    tables, all_tables = tables.copy(), all_tables.copy()
    turn = np.arange(len(tables)) % TURNS
    for k in range(TURNS):
        rows = np.flatnonzero(turn == k)
        if len(rows):
            where = restaurant[rows]
            drawn = draw_tables(customers[rows], parent[rows], all_tables[where] - tables[rows], discount, strength, rng)
            all_tables += np.bincount(where, drawn - tables[rows], len(all_tables)).astype(np.int64)
            tables[rows] = drawn
    return tables, all_tables


def strength_scores(customers: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """For each of ``STRENGTHS`` the log-likelihood of the restaurants' totals."""
    there = customers > 0
    # Many restaurants are alike.
    pairs, n = np.unique(np.stack([customers[there], tables[there]]), axis=1, return_counts=True) if there.any() else (np.zeros((2, 0)), np.zeros(0))
    c, t = pairs.astype(np.float64)
    out = np.zeros(len(STRENGTHS))
    for i, s in enumerate(STRENGTHS):
        opened = (t - 1) * np.log(discount) + log_gamma(s / discount + t) - log_gamma(s / discount + 1)
        out[i] = (n * (opened - log_gamma(s + c) + log_gamma(s + 1))).sum()
    return out


def draw_strength(scores: np.ndarray, rng: np.random.Generator) -> float:
    return float(STRENGTHS[np.argmax(scores + rng.gumbel(size=len(scores)))])


def estimated_discount(once: float, twice: float) -> float:
    """From how many dishes have one and two customers."""
    return float(np.clip(once / (once + 2 * twice), 0.05, 0.95)) if once else 0.5
