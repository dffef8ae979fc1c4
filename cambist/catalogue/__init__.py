"""The registered queries: star-schema tables mapped to payments, and the operators run over them."""
