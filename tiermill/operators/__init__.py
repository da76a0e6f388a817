"""DataFrame operators: cleaning, JSON messages, enriching joins, grouped averages."""
