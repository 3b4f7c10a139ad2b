"""sparloom: payload and corpus analytics declared as Spark plans."""
