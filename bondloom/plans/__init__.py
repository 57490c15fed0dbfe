"""Domain plans: curve, relative value, shape, liquidity, dealing, carry, book."""
