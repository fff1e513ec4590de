"""tideline: snapshot analytics on Spark, with DataFrame-native operators."""
