"""The built-in analyses; importing this package registers them."""

from popscan.analyses import costs, death, dimensions, domains, payer, periods, person, values

__all__ = ["costs", "death", "dimensions", "domains", "payer", "periods", "person", "values"]
