"""headway: public-transport tables, schedule questions and live feeds on Spark."""
