"""Steps of the governance run, each a DataFrame transformation, and the jobs that store them."""
